"""Small tables with every awkward case, and a helper to build them."""

import random

CLASH = ["row_id", "run", "sha", "key", "n", "rank", "kept", "_id", "_h", "score"]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_texts(seed=3):
    """(doc_id, text) rows: null and empty texts, white space, repeated rows,
    a null id, near and exact copies, a very long text."""
    rng = random.Random(seed)
    base = words(rng, 120)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one two"), (5, "One\tTWO "), (6, base), (7, base.upper()), (8, base.replace(" ", "  "))]
    toks = base.split()
    for i in range(9, 15):
        t = list(toks)
        t[(i * 7) % 120] = f"x{i}"
        rows.append((i, " ".join(t)))
    rows += [(15, " ".join(toks[:60]) + " " + words(rng, 60)), (15, " ".join(toks[:60]) + " other"), (16, base), (16, base)]
    rows += [(None, base), (None, "a b c d e f"), (17, words(rng, 20_000, 5000)), (18, "É é K k İ ſ\nline\nLINE \n\n"), (19, "x" * 50_000)]
    rows += [(i, words(rng, 30)) for i in range(20, 40)]
    return rows


def documents(spark, rows, clash=True):
    extra = ", ".join(f"`{c}` string" for c in CLASH) if clash else ""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + (f", {extra}" if clash else "")
    full = [(i, t, None, f"src{(i or 0) % 3}" if i != 4 else None, len(t or ""), *([f"v{i}"] * len(CLASH) if clash else [])) for i, t in rows]
    return spark.createDataFrame(full, schema).repartition(3)
