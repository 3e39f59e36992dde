"""License notices against exact containment."""

import random

from ledgerlens.llm import licenses
from ledgerlens.llm.queries import op7_license_scan
from samples import SF, documents, nothing, odd  # noqa: F401


def test_every_notice_is_found_and_nothing_else(spark, documents):
    got = {(r["doc_id"], r["license"]) for r in op7_license_scan(spark, SF).collect()}
    want = {(d["doc_id"], name) for d in documents.collect() for name, text in licenses.NOTICES if text in d["text"]}
    assert want and got == want


def test_changed_and_shifted_notices(spark):
    body = [f"w{i}" for i in range(40)]
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted."
    docs = [(n, " ".join(body[:n] + [notice.upper() if n % 2 else notice] + body[n:])) for n in range(40)]
    docs += [(100, notice.replace("modification", "changes")), (101, "licensed under the big tree"), (102, "redistribution and use in source and")]
    out = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), licenses.notices(spark)).collect()
    assert {r["doc_id"] for r in out} == {*range(40), 100} and {r["license"] for r in out} == {"BSD-3-Clause"}
    assert all(r["containment"] >= 0.8 for r in out)


def test_no_python_in_the_plan(spark, documents):
    plan = licenses.scan_licenses(documents, licenses.notices(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "MapInArrow"))


def test_odd_rows(spark, odd, nothing):
    assert licenses.scan_licenses(odd, licenses.notices(spark)).count() == 0
    assert licenses.scan_licenses(nothing, licenses.notices(spark)).count() == 0
    blank = spark.createDataFrame([(1, "x", None), (2, "y", "")], "template_id long, license string, text string")
    assert licenses.scan_licenses(odd, blank).count() == 0


def test_headers_and_their_families(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    docs, want = [], set()
    for n, (name, _, text) in enumerate(licenses.HEADERS):
        lines = text.replace(" you ", "\n# you ").replace(" of ", " of\n * ")
        docs += [(n, f"{filler[: 7 * n]} {lines} {filler}"), (100 + n, text.upper())]
        want |= {(n, name), (100 + n, name)}
    by = {name: text for name, _, text in licenses.HEADERS}
    # a verbatim and a slightly changed header of one family, far apart, are both named; side by side with another family too
    docs += [(200, f"{by['GPL-3.0']} {filler} {filler} {by['GPL-2.0'].replace('library', 'work')}"), (201, by["MIT"] + " " + by["ISC"].replace("fee", "charge"))]
    want |= {(200, "GPL-3.0"), (200, "GPL-2.0"), (201, "MIT"), (201, "ISC")}
    docs += [(300, by["MIT"][:150]), (301, "free software is redistributed by any person under the terms of a license")]
    out = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), licenses.notices(spark)).collect()
    assert {(r["doc_id"], r["license"]) for r in out if r["license"] in by} == want


def test_blocks_of_templates_change_nothing(spark, documents):
    rnd = random.Random(4)
    pool = [f"t{i}" for i in range(900)]
    texts = [" ".join(rnd.choices(pool, k=rnd.randrange(5, 60))) for _ in range(60)]
    templates = spark.createDataFrame([(n, f"L{n}", t) for n, t in enumerate(texts)], "template_id long, license string, text string")
    docs = []
    for n in range(200):
        words = texts[n % 60].split()
        for k in rnd.sample(range(len(words)), len(words) // 12 if n % 3 else 0):
            words[k] = "changed"
        docs.append((n, " ".join(rnd.choices(pool, k=n % 41) + words + rnd.choices(pool, k=25))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    scans = [{tuple(r) for r in licenses.scan_licenses(frame, templates, most_shingles=most).collect()} for most in (20_000, 500)]

    def shingles(text):
        words = text.split()
        return list(zip(words, words[1:]))

    def best(template, text):
        wanted, inside = set(shingles(template)), shingles(text)
        return max(len(wanted & set(inside[max(0, s - len(wanted)) : max(0, s - len(wanted)) + 2 * len(wanted) + 12])) for s in range(0, len(inside), 6)) / len(wanted)

    exact = {(d, f"L{n}") for d, text in docs for n, t in enumerate(texts) if best(t, text) >= 0.8}
    assert scans[0] == scans[1] and {r[:2] for r in scans[0]} == exact and len(exact) >= 150
    assert licenses._blocks([(1, 5), (2, 5), (3, 1), (4, 90), (5, 2)], 10) == [[1, 2], [3], [4], [5]]
