"""Rows that hold every hard case."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept int, size string"

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
         "upsilon phi chi psi omega one two three four five six seven eight nine ten").split()


def text(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed + 3) + i // 5) % len(WORDS)] + str((i * seed) % 11) for i in range(n))


def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    base = text(1, 200)
    near = base.split()
    near[100] = "CHANGED"
    texts = [
        None, "", " \n\t", "word", "Two words", base, base, base.upper(), " ".join(near), text(2, 120),
        text(3, 70) + " " + text(1, 60) + "\n\n" + text(4, 10), text(5, 6000), "é ü 漢字  x '’s don't <|endoftext|> end",
        "Licensed under CC BY 4.0. All rights reserved. GNU General Public License",
    ]
    out = [(i, t, "en", f"src{i % 3}" if i % 5 else None, len(t) if t else None, 0.5, 1, "x") for i, t in enumerate(texts)]
    out += [(5, base, "en", "src2", None, None, None, None)] * 2 + [(None, base, None, None, None, None, None, None)]
    out.append((None, "lonely text", None, "src1", None, None, None, None))
    return out
