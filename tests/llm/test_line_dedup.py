"""Line dedup against a plain count of pages per (host, line)."""

from collections import Counter

from tablekit.llm import line_dedup as L

SCHEMA = "doc_id long, text string, source string, lines string"


def brute(rows, ratio, least):
    pages = Counter(s for _, _, s, _ in rows if s is not None)
    seen = Counter()
    for _, t, s, _ in rows:
        if s is not None and t is not None:
            seen.update({(s, x.strip(" ")) for x in t.split("\n") if x.strip(" ")})
    out = []
    for d, t, s, e in rows:
        if t is not None and s is not None:
            t = "\n".join(x for x in t.split("\n") if not x.strip(" ")
                          or seen[s, x.strip(" ")] < least or seen[s, x.strip(" ")] / pages[s] <= ratio)
        out.append((d, t, s, e))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = []
    for d in range(120):
        host = "big" if d % 3 else f"h{d % 5}"
        lines = [f"own line {d}", "  footer  " if d % 2 else "footer", "", f"menu {d % 4}", "footer" if d % 10 == 0 else f"x{d}"]
        rows.append((d, "\n".join(lines), host, f"e{d}"))
    rows += [(500, None, "big", "n"), (501, "", "big", "e"), (502, "footer", "big", "all goes"), (503, "footer", None, "no host"),
             (504, "footer\n" * 2000, "one", "lone host"), (7, rows[7][1], rows[7][2], "again")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for ratio, least in ((0.05, 5), (0.3, 2)):
        got = L.drop_boilerplate_lines(frame, max_ratio=ratio, min_pages=least)
        assert got.columns == frame.columns
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, ratio, least)


def test_empty_table_and_report(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert L.drop_boilerplate_lines(empty).count() == 0
    rows = [(i, "same\nown %d" % i, "s", "") for i in range(10)] + [(99, None, "s", "")]
    got = L.drop_boilerplate_lines(spark.createDataFrame(rows, SCHEMA), report=("n", "gone")).collect()
    assert {(r["n"], r["gone"]) for r in got} == {(2, 1), (0, 0)}


def test_report_names_replace_columns_of_the_input(spark):
    rows = [(i, "s", f"foot\nown {i}", 7, "x") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, n_lines long, N_Removed string")
    out = L.drop_boilerplate_lines(frame, report=("n_lines", "n_removed"))
    assert {(r["n_lines"], r["n_removed"], r["text"][:3]) for r in out.select("n_lines", "n_removed", "text").collect()} == {(2, 1, "own")}


def test_shares_on_both_sides_of_the_ratio(spark):
    """Lines on 4, 6, 8, 10 and 12% of a host's 200 pages: the ratio alone decides, in each host by itself."""
    planted = {f"line of {p}%": 2 * p for p in (4, 6, 8, 10, 12)}
    rows = [(h * 1000 + d, "\n".join([f"own {h} {d}", *[x for x, n in planted.items() if (d + 17 * h) % 200 < n]]), f"h{h}", "")
            for h in range(2) for d in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for ratio, gone in ((L.MAX_RATIO, {"line of 12%"}), (0.05, {f"line of {p}%" for p in (6, 8, 10, 12)})):
        left = {x for r in L.drop_boilerplate_lines(frame, max_ratio=ratio).collect() for x in r["text"].split("\n")}
        assert set(planted) - left == gone
        assert len(left) == 400 + len(planted) - len(gone)
