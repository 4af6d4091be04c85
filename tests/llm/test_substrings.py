"""Levels of the substring dedup."""

import random

from pyspark.sql import functions as F


def brute(rows, window):
    """(id, words removed) from all windows of all documents."""
    starts = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - window + 1):
            starts.setdefault(tuple(w[j:j + window]), set()).add(i)
    out = {}
    for i, t in rows:
        w, gone = t.split(), set()
        for j in range(len(w) - window + 1):
            if min(starts[tuple(w[j:j + window])]) < i:
                gone.update(range(j, j + window))
        out[i] = " ".join(x for j, x in enumerate(w) if j not in gone)
    return out


def test_every_level_prunes_and_nothing_is_lost(spark):
    """Short phrases repeat everywhere, longer ones less and less: each
    length leaves fewer candidates than extending the first one would."""
    from tidewatch.llm.substrings import levels, remove_repeats, repeated_windows
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    phrase = {n: [" ".join(word() for _ in range(n)) for _ in range(40)] for n in (4, 5, 7, 9, 12, 13, 20, 40)}
    rows = []
    for i in range(400):
        parts = [" ".join(word() for _ in range(rng.randrange(5, 30)))]
        for _ in range(8):
            parts += [rng.choice(phrase[rng.choice([4, 4, 4, 4, 5, 5, 5, 7, 9, 12, 13, 20, 40])]), " ".join(word() for _ in range(rng.randrange(0, 4)))]
        rows.append((i, " ".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for window in (13, 30, 6):
        got = {r.doc_id: r.kept for r in remove_repeats(df, window=window).collect()}
        assert got == brute(rows, window)
    report = []
    repeated_windows(df, window=13, report=report)
    assert [n for n, _ in report] == levels(13) == [4, 7, 13]
    one_jump = 10 * report[0][1]        # 13-word windows around every repeated 4-word one, less overlaps
    assert 0 < report[1][1] <= 2 * report[0][1] and report[2][1] < one_jump / 2


def test_levels_stop_when_no_candidate_survives(spark):
    from tidewatch.llm.substrings import repeated_windows
    rng = random.Random(5)
    shared = " ".join(f"p{i}" for i in range(6))
    rows = [(i, " ".join([*(f"a{i}_{j}" for j in range(15)), shared, *(f"b{i}_{j}" for j in range(15))])) for i in range(20)]
    report = []
    flags, copies = repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), window=100, report=report)
    assert flags.count() == 0 and [n for n, _ in report][0] == 4 and len(report) <= 3 and report[-1][0] in (13, 100)
    long = " ".join(f"q{rng.randrange(9999)}" for _ in range(300))
    report = []
    flags, _ = repeated_windows(spark.createDataFrame([(1, long), (2, "x " + long)], "doc_id long, text string"), window=100, report=report)
    assert [n for n, _ in report] == [4, 7, 13, 25, 50, 100] and flags.select(F.size("starts")).collect()[0][0] == 201
