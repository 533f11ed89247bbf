"""Rows and paths that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def tricky_rows():
    """Nulls, empty, white and very long texts, exact copies, near copies, repeated rows and ids, shared passages."""
    words = [f"w{(i * i * 7 + 3 * i) % 1009}" for i in range(4000)]
    a = " ".join(words[:300])
    b = " ".join(words[:150] + ["changed"] + words[151:300])
    passage = " ".join(words[1000:1060])
    rows = [
        (1, a, "en", "s1", 1), (2, a, "en", "s1", 1), (3, b, "en", "s2", 1), (3, b, "en", "s2", 1), (3, "another text of id 3", "fr", None, 1),
        (4, None, None, None, None), (5, "", "en", "s2", 0), (6, " \t\n\x0b\x0c\r ", "en", "s3", 3), (7, "One two", "en", "s3", 7), (8, "one TWO", "en", "s3", 7),
        (None, "no id here " + passage, "en", "s1", 1), (None, None, None, "s1", None), (9, passage + " tail one " + " ".join(words[2000:2100]), "en", "s1", 1),
        (10, " ".join(words[2200:2300]) + "\n" + passage + "\n" + passage, "en", "s9", 1), (11, " ".join(words * 20), "en", "s1", 1),
        (12, "é" * 400 + " " + "ü" * 300, "de", "s2", 1), (13, "x" * 500, "en", "s2", 500), (14, "<|endoftext|> it's odd 　 \U0001f600", "en", "s2", 9),
        (15, "line\nline\n\n \nother\nline\r\n#*$%&|<>", "en", "s2", 9),
    ]
    return rows
