import hashlib
import random
from math import ceil, floor

import numpy as np

import corpus_pipeline
from seisloom.llm import bpe, language, line_dedup, mixing, simhash

LAST = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "source", "lang"]


def test_stages_keep_columns(spark, docs, tmp_path):
    rows = docs.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, str(tmp_path))
        if name != "bpe":
            assert out.columns == list(corpus_pipeline.COLUMNS)
            out.write.parquet(str(tmp_path / name))
            rows = spark.read.parquet(str(tmp_path / name))
    ids = [r.doc_id for r in out.collect()]
    assert 3 not in ids and 2 not in ids


def by_hand(model, rows):
    """The stages in plain Python, without keys, buckets or prefix sums. ``rows`` are (doc_id, text, lang, source, n_chars)."""
    rows = [r for r in rows if (p := model.predict(r[1]))[0] != language.UNKNOWN and p[1] >= 0.25]
    hosts = {}
    for r in rows:
        hosts.setdefault(r[3], set()).add(r[1])
    bad = {}
    for host, pages in hosts.items():
        lines = {}
        for page in pages:
            for line in set(page.split("\n")):
                lines[line] = lines.get(line, 0) + 1
        bad[host] = {x for x, n in lines.items() if n >= line_dedup.MIN_PAGES and n > len(pages) * line_dedup.RATIO}
    rows = [(r[0], "\n".join(x for x in r[1].split("\n") if x not in bad[r[3]]), *r[2:]) for r in rows]
    prints = [(simhash.fingerprint(r[1].encode(), 5), simhash.word_fingerprints(r[1].encode())) for r in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, (a, b) in enumerate(prints):
        for j in range(i):
            if a == prints[j][0] or ((a ^ prints[j][0]).bit_count() <= 14 and min((x ^ y).bit_count() for x, y in zip(b, prints[j][1], strict=True)) <= 6):
                top[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    sizes = [len((r[1] or "").split()) for r in rows]
    words = {}
    for r, n in zip(rows, sizes, strict=True):
        words[r[3]] = words.get(r[3], 0) + n
    names = sorted(s for s in words if s is not None) + [s for s in words if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        rest = mixing.SHARE * sum(words.values()) - sum(target[s] for s in names if s not in open_)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[x] for x in open_)
        over = {s for s in open_ if target[s] > 2 * words[s]}
        if not over:
            break
        target.update({s: 2.0 * words[s] for s in over})
        open_ -= over
    encoding, out = bpe.encoding(bpe.default_ranks()), []
    key = lambda r: int(hashlib.md5(f"{'' if r[0] is None else r[0]}{mixing.SEED}".encode()).hexdigest()[:15], 16)
    for s in names:
        mine, before, budget = sorted(((key(r), r, n) for r, n in zip(rows, sizes, strict=True) if r[3] == s), key=lambda x: x[0]), 0, floor(target[s])
        passes = budget // words[s] if words[s] else 0
        for _, r, n in mine:
            taken = passes * n + max(0, min(n, budget - passes * words[s] - before))
            before += n
            ids = encoding.encode_ordinary(r[1])
            row = (r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest(), r[3], r[2])
            out += [row] * (ceil(taken / n) if n else 0)
    return out


def test_run_against_plain_python(spark, docs, tmp_path):
    draw = random.Random(3)
    english = "the of and to in is was for that with as his on be at by had not are but from or have an they which one you were all her she there would their".split()
    german = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am".split()

    def prose(words, n):
        return " ".join(draw.choice(words) + ("" if draw.random() < 0.5 else draw.choice(words)) for _ in range(n))

    rows = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    for i in range(120):
        lang, words = ("en", english) if i % 2 else ("de", german)
        text = prose(words, draw.randrange(20, 150)) + ("\nread more here" if i % 4 == 2 and i % 5 else "") + "\n" + prose(words, 30)
        rows.append((100 + i, text, lang if i % 9 else None, f"site{i % 4}", len(text)))
        if i % 10 == 0:  # a copy with a later id, one without an id, and another text of the same id
            rows += [(400 + i, text, lang, "site0", 0), (None, text, lang, None, 0), (100 + i, prose(words, 90), lang, "site1", 0)]
        if i % 15 == 0:
            other = text.split(" ")
            other[5] = "changed"
            rows.append((500 + i, " ".join(other), lang, "site2", 0))
    rows += [(None, prose(english, 60), "en", "site3", 0)]
    spark.createDataFrame(rows, docs.select(*corpus_pipeline.COLUMNS).schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == LAST
    want = by_hand(language.train(spark.read.parquet(str(tmp_path / "documents.parquet"))), rows)
    got = [tuple(r) for r in out.collect()]
    assert len(want) > 100
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert np.unique([r[0] or -1 for r in got]).size > 60


def test_empty(spark, empty, tmp_path):
    empty.select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_of_the_table(spark):
    """Of all pairs of documents of a Jaccard similarity of 0.8 or more on five words 0.9 at least meet; unlike ones do not."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    shingles, same = {}, {}
    for i, t in rows.items():
        words = (t or "").lower().encode().split()
        s = frozenset(b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        shingles[same.setdefault(s, i)] = s
    often, seen, near = {}, {}, []
    for s in shingles.values():
        for x in s:
            often[x] = often.get(x, 0) + 1
    for i, s in shingles.items():  # pairs that share one of their rare shingles
        prefix = sorted(s, key=lambda x: (often[x], x))[: len(s) - ceil(0.8 * len(s)) + 1]
        for j in {j for x in prefix for j in seen.get(x, ())}:
            both = len(s & shingles[j])
            if both >= 0.8 * (len(s) + len(shingles[j]) - both):
                near.append((i, j))
        for x in prefix:
            seen.setdefault(x, []).append(i)
    found = simhash.near_duplicates(docs, width=5, distance=14, by_words=True)
    group = {r.doc_id: r.component_id for r in found.collect()}
    assert len(near) > 30 and sum(group[i] == group[j] for i, j in near) >= 0.9 * len(near)
    members = {}
    for i in shingles:
        members.setdefault(group[i], []).append(i)
    for ids in members.values():  # each is like another of its group
        for i in ids if len(ids) > 1 else ():
            likes = (len(shingles[i] & shingles[j]) / max(1, len(shingles[i] | shingles[j])) for j in ids if j != i)
            assert max(likes) >= 0.4 or len(shingles[i]) <= 8
