"""Rows that all operators are tried on."""


def doc_rows():
    """Nulls everywhere, empty and long texts, ties and repeated rows."""
    words = "the of and to in is that for on with as by at from it an be this".split()
    text = lambda n, k=1: " ".join(words[(i * i + k * i) % 18] + str(i * k % 7) for i in range(n))
    rows = [(1, text(60), "en", "a"), (2, text(60), "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, text(3), "de", "c"), (6, text(30000, 3), "en", "a"), (7, text(60, 5) + " <|endoftext|>\n x", "fr", None)]
    rows += [(8, text(90, 7), "en", "b"), (8, text(90, 7), "en", "b"), (8, text(40, 11), "en", "b"), (None, text(25, 13), "en", "a"), (None, None, None, None), (-3, " \n\t ", "en", "d"), (9, "été " * 30 + "\x85 日本", "fr", "é")]
    return rows + [(100 + k, text(20 + 7 * k, k), "en", "s%d" % (k % 3)) for k in range(40)]
