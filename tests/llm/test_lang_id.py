"""Word-first backoff, recomputed word by word."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

SCHEMA = "doc_id long, text string, lang string, lang_pred int, score string, n int"


def slow_model(rows):
    """{lang: {n: Counter}} of all labelled rows, n = 0 for words."""
    counts = defaultdict(lambda: defaultdict(Counter))
    for _, text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            counts[lang][0][w] += 1
            for n in range(1, 5):
                marked = f"^{w}$" if n > 1 else w
                for i in range(len(marked) - n + 1):
                    counts[lang][n][marked[i:i + n]] += 1
    return counts


def slow_predict(counts, prior, text):
    langs = sorted(counts)
    known = {n: {g for la in langs for g in counts[la][n]} for n in range(5)}
    log = lambda la, n, g: math.log((counts[la][n][g] + 0.5) / (sum(counts[la][n].values()) + 0.5 * len(known[n])))
    total = {la: math.log(prior[la] / sum(prior.values())) for la in langs}
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        if w in known[0]:
            for la in langs:
                total[la] += log(la, 0, w)
            continue
        for n in range(4, 0, -1):
            marked = f"^{w}$" if n > 1 else w
            gs = [g for g in (marked[i:i + n] for i in range(len(marked) - n + 1)) if g in known[n]]
            if gs:
                for la in langs:
                    total[la] += sum(log(la, n, g) for g in gs) / len(gs)
                break
    best = min(langs, key=lambda la: (-total[la], la))
    return best, 1 / sum(math.exp(total[la] - total[best]) for la in langs)


def test_backoff_equals_a_plain_recomputation(spark):
    from tidewatch.llm.lang_id import fit, predict
    rng = random.Random(1)
    parts = {"aa": ["ka", "lo", "mi", "tra"], "bb": ["ze", "ka", "nor", "ü"], "cc": ["xi", "qua", "lo", "né"]}
    word = lambda la: "".join(rng.choice(parts[la]) for _ in range(rng.randrange(1, 4)))
    train = [(i, " ".join(word(la) for _ in range(rng.randrange(1, 30))), la) for i, la in enumerate(["aa"] * 60 + ["bb"] * 30 + ["cc"] * 45)]
    model = fit(spark.createDataFrame([(*r, 1, "x", 2) for r in train], SCHEMA))
    counts, prior = slow_model(train), Counter(la for _, _, la in train)
    for n in range(5):          # nothing of the sample is dropped
        assert set(model.tables[n][0].to_pylist()) == {g for la in counts for g in counts[la][n]}
    tests = [(i, " ".join(word(rng.choice(list(parts))) for _ in range(rng.randrange(1, 6))) + rng.choice(["", " zzz", " tranor", " Ünéx"]), None)
             for i in range(80)] + [(900, "qqq 12", None), (901, "ж", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(spark.createDataFrame([(*r, 1, "x", 2) for r in tests], SCHEMA), model).collect()}
    for i, text, _ in tests:
        lang, score = slow_predict(counts, prior, text)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score), text


def test_languages_of_noisy_labels_are_bounded(spark):
    from tidewatch.llm.lang_id import fit
    rows = [(i, "alpha beta", "en") for i in range(5)] + [(10 + i, "gamma", "fr") for i in range(3)] + [(20 + i, "delta", f"noise{i}") for i in range(50)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    assert fit(df, most_langs=2).langs == ["en", "fr"]
    assert len(fit(df, most_langs=10).langs) == 10 and len(fit(df).langs) == 52
