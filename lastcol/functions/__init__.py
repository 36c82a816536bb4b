from lastcol.functions.text import (chars, encoded_run_bytes, grams, match_positions,
                                    occurrences, pattern_grams, regex_literal)

__all__ = ["chars", "encoded_run_bytes", "grams", "match_positions", "occurrences",
           "pattern_grams", "regex_literal"]
