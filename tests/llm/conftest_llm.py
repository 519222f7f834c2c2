"""Rows that the tests share."""

#: Rows that every operator must take: nulls, empties, repeats, a long text, other scripts.
ODD = [(None, "alpha beta"), (1, None), (2, ""), (3, "\n\n \n"), (4, "alpha beta gamma"), (4, "alpha beta gamma"), (5, "é漢 😀 é漢 😀\n" * 40),
       (6, "word " * 30_000), (7, "x" * 50_000), (8, "\x00\x01 a\x0bb\x0cc\rd")]
