"""Personal data: patterns against plain regular expressions, the field
against enumeration of all segmentations, and what the model adds."""

import itertools
import math
import random
import re

import pytest

SCHEMA = "doc_id long, text string, id string, spans int, base int"


def slow_luhn(d):
    n = [int(c) for c in d][::-1]
    return (sum(n[::2]) + sum(sum(divmod(2 * x, 10)) for x in n[1::2])) % 10 == 0


def slow_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and slow_luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def random_text(rng):
    piece = ["a", "Zé", "@", ".", "-", "+", "(", ")", " ", "  ", "0", "7", "255", "256", "4111111111111111", "4111-1111 1111 1111", "ü",
             "x.y", "10.0.0.1", "+1 (555) 555-1234", "me@b.co", "\n", "_", "%", "٣", "000", "\U0001F600"]
    return "".join(rng.choice(piece) for _ in range(rng.randrange(0, 40)))


def test_patterns_equal_plain_regular_expressions():
    from tidewatch.llm.pii import KINDS, base_spans
    rng = random.Random(8)
    for text in [random_text(rng) for _ in range(6000)] + ["", "a@b@c.d.e@f.g", "1.2.3.4.5.6.7.8", "0001.02.3.0000255", "@x.y", "+1" + " 2" * 9]:
        assert [(KINDS[k], s, e) for k, s, e in base_spans(text)[0]] == slow_base(text), text


def all_paths(field, lat):
    """(score, segments) of every way through a lattice."""
    steps, turns = field._steps(lat)

    def walk(i, y):
        if i == len(lat.atoms):
            yield 0.0, ()
        else:
            for b, z, s, _ in steps[i]:
                for rest, path in walk(b, z):
                    yield turns[y][z] + s + rest, ((i, b, z), *path)
    return list(walk(0, 4))


def test_dynamic_programming_equals_enumeration():
    from tidewatch.llm.pii import Field, Lattice
    rng = random.Random(1)
    for text, given in [("+1 (555) 555-1234 4111111111111111", []), ("10.20.30.40 5.6.7.8", []), ("a.b@c.de.fg 55512345", []),
                        ("10.20.30.40 12345678 99", [(1, 0, 11)])]:
        lat = Lattice(text, " ", "", given)
        assert lat.free
        names = sorted({x for s in lat.segments for x in s[3]} | {x for f in lat.out for x in f or ()} | {f"t{y}{z}" for y in range(5) for z in range(5)})
        field = Field({x: rng.uniform(-2, 2) for x in names}, range(4))
        paths = all_paths(field, lat)
        best = max(paths)[1]
        assert field.best(lat) == [s for s in best if s[2] != 4]
        total, expected, turned = field.sums(lat)
        whole = math.log(sum(math.exp(s) for s, _ in paths))
        assert total == pytest.approx(whole)
        for i, (b, z, _, _), p in expected:
            assert p == pytest.approx(sum(math.exp(s - whole) for s, path in paths if (i, b, z) in path))
        for y, z in itertools.product(range(5), range(5)):
            n = sum(math.exp(s - whole) * sum((q[2], r[2]) == (y, z) for q, r in zip(((0, 0, 4), *path), path)) for s, path in paths)
            assert turned[y, z] == pytest.approx(n)


def rows(rng):
    """Documents with one piece of personal data each, and plain ones."""
    def card():
        d = [4] + [rng.randrange(10) for _ in range(14)]
        return next("".join(map(str, d + [c])) for c in range(10) if slow_luhn("".join(map(str, d + [c]))))
    made = {"email": lambda: f"ab.{rng.randrange(10, 99)}@mail{rng.randrange(9)}.example.com", "card": card,
            "ip": lambda: ".".join(str(rng.randrange(10, 255)) for _ in range(4)),
            "phone": lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"}
    out = []
    for i in range(240):
        kind = list(made)[i % 4]
        out.append((i, f"Some words here {made[kind]()} and others"))
        out.append((1000 + i, f"In {rng.randrange(1900, 2030)} there were {rng.randrange(10 ** 8, 10 ** 12)} of them, ids {rng.randrange(10 ** 7, 10 ** 9)}"))
    return out, made


def found(spark, data, **more):
    from tidewatch.llm.pii import personal_data
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in data], SCHEMA).repartition(3)
    return personal_data(d, **more)


def test_model_adds_what_failing_matches_swallow_and_nothing_else(spark):
    rng = random.Random(2)
    train, made = rows(rng)
    while True:     # the patterns miss the card in both places
        phone, card, ip = made["phone"](), made["card"](), made["ip"]()
        if not any(k in ("card", "phone") for t in (f"{phone} {card}", f"{card} {ip}", f"{phone} {ip}") for k, _, _ in slow_base(t)):
            break
    odd = [(5001, f"call {phone} {card} now"), (5002, f"x {card} {ip} y"), (5003, f"{phone} {ip}"), (5004, "josé@mail3.example.com"),
           (5005, "no data, only 2020 and 17.5 and 1234"), (5006, "  "), (5007, None), (5008, ""), (None, f"é {card}"), (5009, f"é {card}"),
           (5009, f"é {card}"), (5010, "word " * 50000 + phone + " " + card), (5011, "9" * 30000), (5012, "12 34 " * 9000 + "x " + card)]
    report = {}
    got = [(r.id, [(s.kind, s.start, s.stop, s.base) for s in r.spans]) for r in found(spark, train + odd, report=report).collect()]
    by = dict(got)
    assert len(got) == len(train) + len(odd) and 0 < report["islands"] <= 5 * 400
    text = {i: t or "" for i, t in train + odd}
    for i, spans in got:
        base = [s[:3] for s in spans if s[3]]
        want = slow_base(text[i]) if i != 5012 else [("card", len(text[i]) - len(card), len(text[i]))]
        assert base == want, i
        order = [("email", "ip", "card", "phone").index(s[0]) for s in spans]
        assert [(k, s[1]) for k, s in zip(order, spans)] == sorted((k, s[1]) for k, s in zip(order, spans))
        if i is not None and i < 5000:
            assert len(base) == len(spans), (i, spans)        # plain documents are left alone
    words = lambda i: {(s[0], text[i][s[1]:s[2]]) for s in by[i]}
    assert words(5001) == {("phone", phone), ("card", card)}
    assert words(5002) == {("card", card), ("ip", ip)}
    assert words(5003) == {("phone", phone), ("ip", ip)}
    assert words(5010) == {("phone", phone), ("card", card)}
    assert by[5005] == by[5006] == by[5007] == by[5008] == by[5011] == []


def test_windows_agree_with_one_lattice(monkeypatch):
    from tidewatch.llm import pii
    rng = random.Random(6)
    train, made = rows(rng)
    seen = [dict(x) for _, t in train for x in pii.islands(t, *pii.base_spans(t))]
    field = pii.Field.fit(pii.examples(seen), steps=25)
    text = " ".join(made[rng.choice(["ip", "phone", "card"])]() for _ in range(300))
    given = [(k, s, e) for k, s, e in pii.base_spans(text)[0] if k == pii.IP]
    whole = sorted(field.add(pii.Lattice(text, "", "", given), 0.9), key=lambda x: x[1])
    monkeypatch.setattr(pii, "WINDOW", 700)
    monkeypatch.setattr(pii, "MARGIN", 300)
    assert field.find(text, "", "", given, 0.9) == whole and len(whole) > 100


def test_empty_and_untrained(spark):
    assert found(spark, []).collect() == []
    only = found(spark, [(1, "at 555-123-4567 or 12345678"), (2, None)]).collect()
    assert [(r.id, r.spans) for r in sorted(only)] == [(1, []), (2, [])]


def test_query_columns(spark, tmp_path):
    """The digest columns of the query against plain regular expressions."""
    import hashlib
    from tidewatch.llm.queries import QUERIES
    train, made = rows(random.Random(3))
    data = train[:60] + [(9001, f"{made['phone']()} and {made['email']()}"), (9002, None), (9003, "né 10.2.3.4")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_personal_data"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {i for i, _ in data} and len(got) == len(data)
    for r in got:
        base = slow_base(dict(data)[r.doc_id] or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, _, _ in base) for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))
