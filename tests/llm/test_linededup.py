"""Lines that a host's documents share, against a plain count."""

import random
from collections import Counter, defaultdict

from orrery.llm import linededup

SCHEMA = "doc_id long, source string, text string"


def brute(rows, ratio=linededup.RATIO, least=linededup.LEAST):
    pages, held = Counter(), defaultdict(Counter)
    key = lambda x: x.strip(" \t\r\x0b\x0c")
    for _, s, t in rows:
        pages[s] += 1
        held[s].update({key(x) for x in (t or "").split("\n")} - {""} if t is not None else set())
    out = []
    for i, s, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        kept = [x for x in lines if not (held[s][key(x)] >= max(least, ratio * pages[s]))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    got = linededup.drop_lines(spark.createDataFrame(rows, SCHEMA), **kw)
    return sorted(((r.doc_id, r.text, r["__n_lines"], r["__n_dropped"]) for r in got.collect()), key=str)


def test_small_hosts_take_the_ratio(spark):
    rows = []
    for pages, held in ((3, 3), (9, 9), (20, 9), (20, 2), (2, 2), (100, 10), (100, 9)):
        rows += [(len(rows) + i, f"{pages}-{held}", f"own {pages} {i}\n" + ("menu" if i < held else "other %d" % i)) for i in range(pages)]
    got = run(spark, rows)
    assert got == brute(rows)
    gone = Counter(rows[i][1] for i, _, _, dropped in got if dropped)
    assert gone == {"3-3": 3, "9-9": 9, "20-9": 9, "100-10": 10}


def test_random_hosts(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        s = rnd.choice(["hot"] * 6 + ["b", "c", None])
        lines = [rnd.choice([f"menu {k}" for k in range(40)] + ["", "  ", f"own {i}"] * 8) for _ in range(rnd.randrange(12))]
        rows.append((i, s, "\n".join(x + rnd.choice(["", " ", "\r"]) for x in lines) if i % 50 else None))
    rows += rows[:5]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, ratio=0.03, least=3) == brute(rows, 0.03, 3)


def test_plan_runs_no_python(spark):
    df = linededup.drop_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_awkward_rows(awkward, empty):
    out = linededup.drop_lines(awkward)
    assert out.columns == [*awkward.columns, "__n_lines", "__n_dropped"]
    assert sorted(map(str, out.drop("__n_lines", "__n_dropped").collect())) == sorted(map(str, awkward.collect()))
    assert linededup.drop_lines(empty).count() == 0
