"""Rows that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "n_words string, score string, _row string, _id string, _label string, "
              "_toxic string, _range string, _salt string, _key string")

PROSE = ("the quick brown fox jumps over the lazy dog while seven wise owls watch from the "
         "old oak tree and the river runs quietly past the mill toward the distant sea")


def odd_rows() -> list[tuple]:
    """Null, empty, blank, tiny, very long, repeated and equal texts; ids repeated and null;
    columns whose names clash with the operators' own."""
    long_text = " ".join(f"word{i % 977} {PROSE.split()[i % 25]}" for i in range(30_000))
    texts = [None, "", " \t\n ", "a", "one two three", "x" * 5000, long_text, PROSE, PROSE,
             PROSE + " again", "Ünïcödé ΣΑΣ 漢字 🎉 ﬁn <|endoftext|> 'll", "\x1c\x1d\x00 \x0b", PROSE]
    rows = [(i, t, "en", "s", 1, "n", "s", "r", *"abcdef") for i, t in enumerate(texts)]
    rows.append(rows[7])  # a repeated row
    rows.append((None, PROSE, *[None] * 12))
    rows.append((None, None, *[None] * 12))
    return rows
