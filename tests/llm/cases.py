"""Tables with the cases that every operator must take."""

from __future__ import annotations

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use inside.
CLASHES = ["id", "f", "row", "print", "part", "position", "codes", "spans", "secrets", "kind", "text_digest", "row_number", "token_count"]
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()


def prose(n: int, seed: int = 0) -> str:
    """Words without repetition of long runs."""
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[state % len(WORDS)] + WORDS[(state >> 8) % len(WORDS)][:3])
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = prose(30_000, 3)
    return [
        (1, prose(80, 1), "la", "s1", 5),
        (1, prose(80, 1), "la", "s1", 5),
        (2, prose(80, 1), None, "s2", None),
        (None, prose(60, 2), "la", None, 3),
        (None, None, None, None, None),
        (3, None, "la", "s1", 0),
        (4, "", "la", "s1", 0),
        (5, " \n\t ", "la", "s1", 4),
        (6, "12 34 !!", "la", "s1", 8),
        (7, long, "la", "s3", len(long)),
        (8, "x" * 50_000, "la", "s3", 50_000),
        (9, "é漢字 😀 <|endoftext|> Ünï", "la", "s1", 9),
    ]


def odd_table(spark):
    """The odd rows, with extra columns under clashing names."""
    schema = PLAIN + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["extra"] * len(CLASHES)) for r in odd_rows()], schema)


def empty_table(spark):
    return spark.createDataFrame([], PLAIN)
