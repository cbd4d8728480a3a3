"""Edge rows that every text operator must take: nulls, empties, long texts, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __row string, value string, start int, `hash` string"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdehinorst") for _ in range(r.randint(2, 7))) + r.choice(["", "", "", ",", "."]) for _ in range(n))


def edge_rows() -> list[tuple]:
    texts = [
        None, "", "   \n\t ", "one", words(1, 60), words(1, 60), words(1, 60) + " tail",
        words(2, 20_000), "x" * 50_000, "9" * 3000, "a@b.c_d@e.f.g@h.i " * 3, "😀 emoji +1 (555) 222-3333 and 4111 1111 1111 1111",
        "!!! ... ###", "\n".join([words(3, 30)] * 5), "token=abcdef12345 " * 40, "é" * 10 + " 10.0.0.1.2.3.4.5 999.1.1.1",
    ]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "src", None, "r", "v", 1, "h") for i, t in enumerate(texts)]
    return rows + [rows[4], (None, words(4, 40), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
