from .logstream import (JAVA_DATE, LEVELS, level_counts, level_share, parse_lines,
                        render_lines, start_level_counts)

__all__ = ["JAVA_DATE", "LEVELS", "level_counts", "level_share", "parse_lines",
           "render_lines", "start_level_counts"]
