"""Small awkward tables: every operator has to give a defined result on them."""

import random

WORDS = "the of and to in was as by for with that from tion sto ber lum pra quet".split()


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) + rng.choice(WORDS) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(n)]
    return " ".join(w + (". " if rng.random() < 0.1 else "") for w in words).replace(".  ", ". ")


def messy_rows() -> list[tuple]:
    rng = random.Random(7)
    body, other = prose(rng, 120), prose(rng, 90)
    long = "\n".join(prose(rng, 200) for _ in range(60))
    texts = [
        body, body, body.upper(), other, other + " tail", None, "", " \t\n ", "word", "two words", long, long + "\nmore",
        "é ß 語 𝔸 🙂 \x00 end", "*** ### $$$", "12 34\n12 34\n12 34", "mail me: a.b@c.example.org or +44 20 7946 0958 now", "<|endoftext|> it's 'RE",
    ]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", i * 0.5) for i, t in enumerate(texts)]
    rows += [(None, body, "en", None, None), (None, None, None, None, None), (3, other, "en", "s0", 1.0), (3, other, "en", "s0", 1.0), (3, long, None, "s1", 2.0)]
    return rows


#: Columns of results and of inner tables, as further columns of the input.
CLASHES = "score size n_tokens key node row part held_out copies rate sha runs a b n code kind text_hash at queue task component_id"


def messy(spark, rows=None):
    rows = messy_rows() if rows is None else rows
    extra = CLASHES.split()
    schema = "doc_id long, text string, lang string, source string, n_chars double, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([r + ("x",) * len(extra) for r in rows], schema)
