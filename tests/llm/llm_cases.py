"""Rows that every operator must cope with."""

#: (doc_id, text): nulls, an empty text, no words, few words, repeats, a copy, a tie.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from it"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one two"),
    (None, "no id here at all, but some words"),
    (6, "The quick brown fox jumps over the lazy dog and runs far away from it"),
    (6, "The quick brown fox jumps over the lazy dog and runs far away from it"),
    (7, "Ünïcode wörds ñ 漢字   and \x1c odd \x85 spaces " * 3),
    (None, None),
]
#: Extra columns whose names clash with those the operators return or use inside.
CLASHES = ["fp", "key", "row", "score", "size", "shard", "kept", "found", "ids", "length"]
