"""Property tests of the pure-Python pieces against brute force."""

import numpy as np
from hypothesis import given, settings, strategies as st

from tabml.operators.recommend import _top_k_cells
from tabml.operators.split import _bounds


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.integers(1, 15), st.integers(0, 10_000))
def test_top_k_cells_exact_with_ties(n_users, n_items, k, seed):
    rng = np.random.default_rng(seed)
    S = rng.integers(-3, 4, size=(n_users, n_items)).astype(float)   # many ties
    rows, cols = _top_k_cells(S, k)
    for u in range(n_users):
        want = sorted(range(n_items), key=lambda j: (-S[u, j], j))[:min(k, n_items)]
        got = sorted(cols[rows == u].tolist(), key=lambda j: (-S[u, j], j))
        assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0.01, 10.0), min_size=1, max_size=6), st.integers(10, 10_000))
def test_split_bounds_partition_the_buckets(weights, buckets):
    b = _bounds(weights, buckets)
    assert b[0][0] == 0 and b[-1][1] == buckets
    assert all(lo <= hi for lo, hi in b)
    assert all(b[i][1] == b[i + 1][0] for i in range(len(b) - 1))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 7), st.integers(1, 30), st.integers(1, 6), st.integers(1, 5),
       st.integers(1, 8), st.integers(0, 10_000))
def test_score_block_chunked_exact(n_users, n_items, k, uc, ic, seed):
    from tabml.operators.recommend import score_block
    rng = np.random.default_rng(seed)
    U = rng.integers(-2, 3, size=(n_users, 3)).astype(float)
    I = rng.integers(-2, 3, size=(n_items, 3)).astype(float)
    ids = np.arange(100, 100 + n_items)
    s, got = score_block(U, I, ids, k, uc, ic)
    S = U @ I.T
    for u in range(n_users):
        want = sorted(range(n_items), key=lambda j: (-S[u, j], j))[:min(k, n_items)]
        assert got[u].tolist() == [int(ids[j]) for j in want]
        assert np.allclose(s[u], [S[u, j] for j in want])
