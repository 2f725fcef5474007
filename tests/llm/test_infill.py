"""Fill-in-middle against a plain computation on code points."""

import hashlib

from pyspark.sql import functions as F

from stumpline.llm import infill

TEXTS = [None, "", "a", "\n", "é😀x\r\n z", "with <P> inside", "a<S", "<M>", "< P>", "$1 \\ $", "😀" * 5000, "<" * 300, "S><P" * 2, "ab " * 70_000]


def expected(doc_id, text):
    t = text or ""
    n = len(t)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_infill_matches_plain_slices_with_nulls_long_and_repeated_rows(spark):
    rows = [(None if i == 3 else 14 * k + i, t) for k in range(20) for i, t in enumerate(TEXTS)] + [(5, "twice")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(1), "form": F.lit("x"), "out": F.lit(2)})

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    want = []
    for i, t in rows:
        n, form, a, m, out = expected(i, t)
        want.append((i, n, form, a, m, sha(out), sha(t or "")))
    got = [tuple(r) for r in infill.digests(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    out = infill.transform(docs)
    assert out.columns == [*docs.columns, "fim_form"]
    made = sorted(((r.doc_id, r.text, r.fim_form) for r in out.collect()), key=str)
    assert made == sorted(((i, expected(i, t)[4], expected(i, t)[1]) for i, t in rows), key=str)
    assert infill.digests(docs.limit(0)).count() == 0
