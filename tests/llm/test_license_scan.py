import random

from seisloom.llm import license_scan


def test_finds_each_template_and_only_them(spark):
    rows = [(i, f"some prose here\n{t}\nmore prose there") for i, t in enumerate(license_scan.TEMPLATES.values())]
    clean = [(100, "prose about a licence to drive and a driver license office"), (101, None), (102, ""), (103, "word " * 50_000 + "license")]
    out = license_scan.scan_licenses(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()
    names = list(license_scan.TEMPLATES)
    found = {r.doc_id: {x.license for x in out if x.doc_id == r.doc_id and x.n_differences == 0} for r in out}
    for i, name in enumerate(names):
        assert name in found[i], name
    assert not set(found) & {100, 101, 102, 103}


def test_wording_differences_decide(spark):
    df = spark.createDataFrame(
        [(1, "This work is licensed under the GNU General Public License, version 2."), (2, "Released under the\nMIT   LICENSE."), (2, "Released under the\nMIT   LICENSE.")],
        "doc_id long, text string",
    )
    out = license_scan.scan_licenses(df).collect()
    assert {r.license for r in out if r.doc_id == 1} == {"GPL-2.0"}
    assert [r.license for r in out if r.doc_id == 2 and r.n_differences == 0] == ["MIT", "MIT"]


def by_hand(scanner, text):
    """Every template against every stretch of the whole text, without cues or compression."""
    every = license_scan.words(text)
    found = sorted((2 * n - len(want), a, b, name, n) for name, want in scanner.words.items() for n, a, b in scanner.stretches(every, name))
    taken = []
    for _, a, b, name, n in found:
        if all(b <= x or y <= a for x, y, *_ in taken):
            taken.append((a, b, name, n))
    return [(name, n) for _, _, name, n in sorted(taken)]


def test_all_that_brute_force_finds(spark):
    scanner, draw, edited = license_scan.Scanner(license_scan.TEMPLATES), random.Random(11), 0
    for trial in range(60):
        parts = []
        for name in draw.sample(sorted(scanner.words), draw.randrange(1, 5)):
            got = list(scanner.words[name])
            for _ in range(draw.randrange(0, int(license_scan.ALLOWED * len(got)) + 2)):  # one more than allowed at most
                i, new = draw.randrange(len(got)), prose(draw.random(), 1)
                got[i : i + 1] = draw.choice([[new], [], [got[i], new], [got[i].upper()]])
                edited += 1
            parts += ["\n".join(got[: len(got) // 2]), " ".join(got[len(got) // 2 :]), prose(trial, draw.randrange(0, 60))]
        text = draw.choice([" ", "\n", ". "]).join(parts)
        assert [(name, n) for _, name, _, n, _ in scanner.scan(text)] == by_hand(scanner, text), text
    assert edited > 200


def test_any_template_has_cues(spark):
    df = spark.createDataFrame([(1, "x\nfree for all of you\ny"), (2, "use it as you may"), (3, "zz ZZ zz yy")], "doc_id long, text string")
    out = license_scan.scan_licenses(df, {"A": "Free for all of you", "B": "zz zz zz xx", "none": "...", "C": "it"}).collect()
    assert sorted((r.doc_id, r.license, r.line, r.n_differences) for r in out) == [(1, "A", 1, 0), (2, "C", 0, 0)]
    assert license_scan.scan_licenses(df, {"none": ""}).count() == 0


def test_cases(docs, empty):
    assert license_scan.scan_licenses(docs).count() == 0 and license_scan.scan_licenses(empty).count() == 0


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghilmnoprstu", k=draw.randrange(2, 10))) for _ in range(n))


def test_exact_wordings_inside_long_lines(spark):
    """Each template with 40 words on each side and far cue-like words in the same line."""
    names = list(license_scan.TEMPLATES)
    rows = [(i, f"public rights {prose(i, 40)} {t} {prose(i + 50, 40)} permission license") for i, t in enumerate(license_scan.TEMPLATES.values())]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.license for r in out if r.n_differences == 0} == dict(enumerate(names))


def test_all_licenses_of_a_line(spark):
    t = license_scan.TEMPLATES
    rows = [(1, f"{t['MIT']} {t['GPL-3.0']} {prose(1, 90)} {t['MIT']}"), (2, t["MIT text"].replace(" ", "\n"))]
    out = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.license for r in out if r.doc_id == 1] == ["MIT", "GPL-3.0", "MIT"]


def test_the_bound_on_bytes_loses_no_allowed_wording():
    scanner, draw = license_scan.Scanner(license_scan.TEMPLATES), random.Random(3)
    for name, want in scanner.words.items():
        for trial in range(60):
            got = list(want)
            for i in draw.sample(range(len(want)), int(license_scan.ALLOWED * len(want))):
                got[i] = prose(trial * 100 + i, 1)
            block = prose(trial, 29).split() + got + prose(trial + 900, 29).split()
            gain = scanner.gain(block, name)
            assert gain >= license_scan.LEAST_GAIN or len(want) < license_scan.SHORT, (name, got)
            assert any(29 <= a < b <= 29 + len(want) for _, a, b in scanner.stretches(block, name))
