"""License scan against brute force over all blocks and templates."""

import random
import re

from tablekit.llm import license_scan as L

SCHEMA = "doc_id long, text string, hits int"


def words(t):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]


def brute(t):
    ws = words(t)
    places = [(i, label) for phrase, label in L.PHRASES.items() for i in range(len(ws)) if ws[i:i + len(phrase.split())] == phrase.split()]
    hits, best = set(), 0.0
    for line in (t or "").split("\n"):
        held = set(words(line))
        for template, label in L.TEMPLATES.items():
            s = set(template.split())
            share = len(held & s) / len(s)
            if len(held & s) >= L.THRESHOLD * len(s) - 1e-9:
                hits.add(label)
                best = max(best, share)
    return len(ws), sorted(places), sorted(hits), best


def texts():
    rnd = random.Random(8)
    vocabulary = sorted({w for t in L.TEMPLATES for w in t.split()})
    out = [None, "", "MIT\nLicense", "mit  LICENSE, mit license. MIT-license", "the mitlicense", "GNU General\tPublic License v3",
           "Ａpache license", "İ Mıt Kelvin K license", "Released under the MIT License.\nAll rights reserved.", "rights all RESERVED",
           "Licensed under CC BY-NC 4.0.", "mit " * 5000 + "license"]
    for _ in range(150):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            ws = rnd.choice(list(L.TEMPLATES)).split() if rnd.random() < 0.7 else []
            ws = [w.title() for w in ws if rnd.random() < 0.9] + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 4))]
            rnd.shuffle(ws)
            lines.append(rnd.choice([" ", ", "]).join(ws))
        out.append("\n".join(lines))
    return out


def test_equals_brute_force(spark):
    rows = [(i % 100, t, i) for i, t in enumerate(texts())] + [(None, "All rights reserved", 0), (3, texts()[3], 1)]
    got = L.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    want = sorted(((d, *brute(t)) for d, t, _ in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], sorted((p["at"], p["label"]) for p in r["places"]), sorted(r["hits"]), r["containment"])
                   for r in got), key=repr) == want


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def runs(t):
    """Labels and containment of lines and of runs of a template's length, over the words of the whole text."""
    _, _, hits, best = brute(t)
    hits, ws = set(hits), words(t)
    for template, label in L.TEMPLATES.items():
        s, n = set(template.split()), len(template.split())
        share = max((len(s & set(ws[i:i + n])) / len(s) for i in range(len(ws))), default=0)
        if share >= L.THRESHOLD - 1e-9:
            hits.add(label)
            best = max(best, share)
    return sorted(hits), best


def test_wrapped_notices(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    mpl = "This file is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"
    filler = "zebra " * 40
    cases = [bsd, mpl, filler + bsd + filler, "/*\n * " + mpl.replace("\n", "\n * "), bsd.replace(" ", "\n"), "all\r\nRIGHTS\n\nreserved",
             "Redistribution and use in source" + "\n" + filler + "\nand binary forms with or without modification are permitted"]
    rnd = random.Random(12)
    for template in L.TEMPLATES:
        ws = template.split()
        for _ in range(6):
            held = [w for w in ws if rnd.random() < 0.92]
            held.insert(rnd.randint(0, len(held)), rnd.choice(["zebra", "#", "the"]))
            cases.append(" ".join(["zebra"] * rnd.randint(0, 20)) + " " + "".join(w + rnd.choice([" ", " ", "\n", ",\n// "]) for w in held) + "zebra\n")
    got = {r["doc_id"]: r for r in L.scan_licenses(spark.createDataFrame([(i, t, 0) for i, t in enumerate(cases)], SCHEMA), wrapped=True).collect()}
    assert {i: (sorted(r["hits"]), r["containment"]) for i, r in got.items()} == {i: runs(t) for i, t in enumerate(cases)}
    assert [got[i]["hits"] for i in range(7)] == [["bsd"], ["mpl"], ["bsd"], ["mpl"], ["bsd"], ["reserved"], []]


def test_phrase_starts_cost_no_more_than_the_text(spark):
    """Every word of a long text may begin a phrase."""
    import time

    def seconds(n):
        frame = spark.createDataFrame([(1, "general " * n + "public license", 0)], SCHEMA)
        t0 = time.perf_counter()
        row = L.scan_licenses(frame).first()
        assert row["n_words"] == n + 2 and [tuple(p) for p in row["places"]] == [(n - 1, "gpl")]
        return time.perf_counter() - t0

    seconds(100)
    assert seconds(80_000) < 20   # a quadratic scan would take hours
