import re
from collections import Counter

import pytest

from seisloom.llm import divergence


def _by_hand(rows, least, top):
    """(lang, source, part, item, value, rank) in plain Python."""
    rows = [(t or "", a or "", s or "") for _, t, a, s, *_ in rows]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = [re.findall(divergence.TERM, t.translate(str.maketrans(upper, upper.lower()))) for t, _, _ in rows]
    out = []
    for lang in {a for _, a, _ in rows}:
        df, of = Counter(), {}
        for (_, a, s), words in zip(rows, terms, strict=True):
            if a == lang:
                df.update(set(words))
                of.setdefault(s, Counter()).update(words)
        kept = {t for t, n in df.items() if n >= least}
        v = len(kept)

        def p(counter, kept=kept, v=v):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // (n + 5 * v) for t in kept}

        every = p(sum(of.values(), Counter()))
        share = {s: p(c) for s, c in of.items()}
        for s, c in of.items():
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in of if o != s]
            found = [(share[s][t] - every[t], t) for t in kept if c[t] > 0 and share[s][t] > every[t]]
            for part, items, most in (("pair", pairs, None), ("term", found, top)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ordered)]
    return sorted(out)


def _rows():
    words = "alpha Beta gamma delta one,two x-ray Über co-op (alpha) alpha's naïve 7up ΣΑΣ".split()
    out = []
    for i in range(400):
        text = " ".join(words[(i * 7 + k * k) % len(words)] + "!" * (k % 3) for k in range(i % 23)) + ("\tBETA\x0bbeta beta" if i % 4 else "")
        out.append((i // 2, text, ["en", "de", None][i % 3], [f"s{i % 11}", "", None][(i % 17) % 3 if i % 5 == 0 else 0], "clash", 1))
    out += [(None, None, "en", "s1", "x", 2), (7, None, "fr", "only", "x", 3), (8, "", "xx", None, "x", 3), (9, "rare words", "xx", "b", "x", 3), out[3], out[3]]
    return out


SCHEMA = "doc_id long, text string, lang string, source string, chunk string, block long"


@pytest.mark.parametrize("side", [256, 3])
def test_against_plain_python(spark, side):
    rows = _rows()
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), side=side, top=4).collect()
    assert sorted(map(tuple, got)) == _by_hand(rows, divergence.LEAST_DOCUMENTS, 4)


def test_empty(spark):
    out = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0


def test_documents_of_a_term_are_united(spark):
    # no chunk alone is in three documents, but the term is; the same document counts once
    rows = [(1, "a, a. a; b", "en", "s"), (2, "a! b?", "en", "t"), (3, "(a) c", "en", "t"), (4, "b", "de", "t")]
    kept, n = divergence.term_counts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), least=3)
    assert [tuple(r) for r in kept.collect()] == [("en", "a")]
    assert sorted(map(tuple, n.collect())) == [("en", "s", "a", 3), ("en", "t", "a", 2)]


def test_large_counts_are_exact(spark):
    row = spark.createDataFrame([(10**12, 3 * 10**14, 10**6)], "n long, total long, size long").select(divergence._p("n", "total", "size").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**12 + 5) // (3 * 10**14 + 5 * 10**6)
