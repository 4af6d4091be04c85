"""Personal data by fixed patterns and a semi-Markov conditional random field.

Patterns give the base spans (email, ip, card, phone): leftmost, not
overlapping within a kind, dropped where a check fails, in time linear in the
text.  A dropped match hides what it swallowed (a phone number followed by a
card number is one failing run of digits), and addresses beyond ASCII match
nothing.  The model finds those:

* An *island* is a stretch of text around digits or an ``@``, cut into atoms
  (runs of digits, runs of letters, single other characters).  Outside of
  islands nothing can be personal data.
* Every range of at most ``MOST_ATOMS`` atoms that fits a kind's hard checks
  is a candidate segment, scored by features of the whole span: digits,
  lengths of its runs, separators, lead, Luhn sum, labels of the domain,
  and the characters beside it.  Atoms outside of segments score by type.
* Semi-Markov dynamic programming over the island, linear in its atoms as
  segments are bounded, picks boundaries and kinds of all segments together.
  Base spans are given; a span found is added where its marginal probability
  reaches ``certain``.  An island of more than ``WINDOW`` characters is
  decoded window by window, each with a margin longer than any segment.

The field is trained on base spans: a bounded sample of distinct islands
whose labelling is beyond doubt, and pairs of them set side by side, by
gradient steps on the conditional likelihood (forward-backward).

Texts are read once; islands and base spans go to a table in the shared
folder, from which both the sample and the decoding are taken.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import Scratch, batches_of

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE, OUT = range(5)
MOST_ATOMS = 40
MOST_CHARS = 256
WINDOW, MARGIN = 1 << 13, 1 << 9
#: Sampled islands per kind (and as many without personal data), and their length.
SAMPLE = 400
SAMPLE_CHARS = 400

_SITE = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBERS = re.compile(r"[+(]{0,2}[0-9]++(?:[\x20().+-]{1,3}[0-9]++)*+")
_ADDRESS = re.compile(r"[\w.%+-]{1,64}@[\w-]++(?:\.[\w-]++)++")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _valid(kind: int, s: str) -> bool:
    if kind == IP:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d) if kind == CARD else 8 <= len(d) <= 15


def base_spans(text: str) -> tuple[list, list]:
    """(spans that pass, spans that fail) of the fixed patterns, as (kind,
    start, end) by kind, then start."""
    good, bad = [], []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            good.append((EMAIL, start, end))
        at = text.find("@", max(at + 1, end))
    for kind, pattern in ((IP, _IP), (CARD, _CARD), (PHONE, _PHONE)):
        for m in pattern.finditer(text):
            (good if _valid(kind, m.group()) else bad).append((kind, m.start(), m.end()))
    return good, bad


# --- candidates ------------------------------------------------------------

def _candidates(text: str, atoms: list) -> list:
    """(first atom, end atom, kind) of every range that fits a kind."""
    out = []
    for a, (start, _, kind) in enumerate(atoms):
        if kind == "9":
            out += _numbers(text, atoms, a, a)
        elif text[start] in "+(" and a + 1 < len(atoms):
            b = a + 2 if text[start] == "+" and text[atoms[a + 1][0]] == "(" and a + 2 < len(atoms) else a + 1
            if atoms[b][2] == "9":
                out += _numbers(text, atoms, a, b)
        elif text[start] == "@":
            out += _addresses(text, atoms, a)
    return out


def _numbers(text: str, atoms: list, first: int, run: int) -> list:
    """Candidates from atom ``first``, whose first run of digits is ``run``."""
    out, n, runs, quad, plain = [], 0, 0, True, first == run
    only = True                     # single spaces and hyphens
    b, gap = run, ""
    while b < len(atoms) and b - first < MOST_ATOMS and n <= 19:
        s, e, kind = atoms[b]
        if kind == "9":
            runs += 1
            n += e - s
            if runs > 1:
                quad &= gap == "."
                only &= gap in ("", " ", "-")
            quad &= e - s <= 3 and int(text[s:e]) <= 255
            whole = b + 1
            if plain and runs == 4 and quad:
                out.append((first, whole, IP))
            if plain and only and 16 <= n <= 19 and luhn(_digits(text[atoms[first][0]:e])):
                out.append((first, whole, CARD))
            if 8 <= n <= 15 and text.count("(", atoms[first][0], e) == text.count(")", atoms[first][0], e):
                out.append((first, whole, PHONE))
            gap = ""
        elif text[s] in " ().-":
            gap += text[s]
            if len(gap) > 3:
                break
        else:
            break
        b += 1
    return out


def _addresses(text: str, atoms: list, at: int) -> list:
    """Candidates around the ``@`` at atom ``at``: the local part starts
    after a separator or as far left as it goes, the domain ends before a dot
    or as far right as it goes."""
    starts, a = [], at
    while a > 0 and at - a < MOST_ATOMS // 2:
        s, e, kind = atoms[a - 1]
        if kind not in "9a" and text[s] not in "._%+-":
            break
        a -= 1
        if kind in "9a" and (a == 0 or atoms[a - 1][2] not in "9a"):
            starts.append(a)
    ends, b, dots = [], at + 1, 0
    while b < len(atoms) and b - at < MOST_ATOMS // 2:
        s, e, kind = atoms[b]
        if kind in "9a":
            if dots and (b + 1 == len(atoms) or atoms[b + 1][2] not in "9a"):
                ends.append(b + 1)
        elif text[s] == "." and atoms[b - 1][2] in "9a":
            dots += 1
        elif text[s] != "-":
            break
        b += 1
    return [(a, b, EMAIL) for a in starts for b in ends if atoms[b - 1][1] - atoms[a][0] <= MOST_CHARS]


# --- features --------------------------------------------------------------

def _side(c: str) -> str:
    if not c:
        return "edge"
    return "9" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c if c.isascii() else "?"


def _span_features(text: str, left: str, right: str, s: int, e: int, kind: int) -> list[str]:
    span, k = text[s:e], KINDS[kind]
    before, after = _side(text[s - 1] if s else left), _side(text[e] if e < len(text) else right)
    out = [f"{k}", f"{k}<{before}", f"{k}>{after}"]
    if kind == EMAIL:
        local, _, domain = span.partition("@")
        labels = domain.split(".")
        last = labels[-1]
        out += [f"{k}n{min(len(labels), 5)}", f"{k}z{'a' if last.isalpha() else '9'}{min(len(last), 6)}",
                f"{k}u{local[0].isalnum()}", f"{k}d{'.' in local}"]
        return out
    runs = re.findall("[0-9]+", span)
    gaps = "".join(sorted(set(span) - set("0123456789")))
    out += [f"{k}n{sum(map(len, runs))}", f"{k}g{gaps}", f"{k}+{span[0] == '+'}",
            f"{k}r{'-'.join(str(len(r)) for r in runs) if len(runs) < 7 and kind != IP else 'many'}"]
    return out


def _atom_feature(text: str, atom: tuple) -> str:
    s, e, kind = atom
    if kind == "9":
        return f"o9{min(e - s, 20)}"
    return "oa" if kind == "a" else f"o{text[s] if text[s].isascii() else '?'}"


class Lattice:
    """Atoms, candidate segments and their features of one island.  Each
    given span is a segment that every path must take; candidates that
    overlap one are no candidates."""

    def __init__(self, text: str, left: str = "", right: str = "", given=()):
        self.atoms = [(m.start(), m.end(), "9" if "0" <= (c := m.group()[0]) <= "9" else "a" if c.isalpha() else ".")
                      for m in _ATOM.finditer(text)]
        starts, ends = [a[0] for a in self.atoms], [a[1] for a in self.atoms]
        edge = [0] * (len(self.atoms) + 1)      # given spans that touch an atom, as rises and falls
        for _, s, e in given:
            edge[bisect_right(ends, s)] += 1
            edge[bisect_left(starts, e)] -= 1
        touched = list(accumulate(map(bool, accumulate(edge[:-1])), initial=0))
        self.free = [(a, b, k) for a, b, k in _candidates(text, self.atoms) if touched[a] == touched[b]]
        self.fixed = []
        opens, closes = {s: i for i, s in enumerate(starts)}, {e: i + 1 for i, e in enumerate(ends)}
        end = 0
        for k, s, e in sorted(given, key=lambda g: (g[1], -g[2], g[0])):
            if s >= end and s in opens and e in closes:
                self.fixed.append((opens[s], closes[e], k))
                end = e
        held = {i for a, b, _ in self.fixed for i in range(a, b)}
        self.out = [None if i in held else [_atom_feature(text, x)] for i, x in enumerate(self.atoms)]
        self.segments = [(a, b, k, _span_features(text, left, right, self.atoms[a][0], self.atoms[b - 1][1], k))
                         for a, b, k in self.free + self.fixed]

    def spans(self, segment) -> tuple[int, int, int]:
        a, b, k = segment[:3]
        return k, self.atoms[a][0], self.atoms[b - 1][1]


# --- the field -------------------------------------------------------------

def _lse(values: list) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


class Field:
    """Weights of features and of transitions between labels."""

    def __init__(self, weights: dict[str, float] | None = None, kinds=()):
        self.w, self.kinds = weights or {}, set(kinds)

    def _steps(self, lat: Lattice):
        """Steps (from atom, to atom, label, score, features) by their start."""
        steps = [[] for _ in range(len(lat.atoms) + 1)]
        for i, f in enumerate(lat.out):
            if f is not None:
                steps[i].append((i + 1, OUT, sum(self.w.get(x, 0.0) for x in f), f))
        for a, b, k, f in lat.segments:
            steps[a].append((b, k, sum(self.w.get(x, -2.0 if x in KINDS else 0.0) for x in f), f))
        turns = [[self.w.get(f"t{y}{z}", 0.0) for z in range(5)] for y in range(5)]
        return steps, turns

    def best(self, lat: Lattice) -> list[tuple]:
        """Segments (first atom, end atom, kind) of the best path."""
        steps, turns = self._steps(lat)
        n = len(lat.atoms)
        score = [[-math.inf] * 5 for _ in range(n + 1)]
        back = [[None] * 5 for _ in range(n + 1)]
        score[0][OUT] = 0.0
        for i in range(n):
            if max(score[i]) == -math.inf:
                continue
            for b, z, s, _ in steps[i]:
                v, y = max((score[i][y] + turns[y][z], y) for y in range(5))
                if v + s > score[b][z]:
                    score[b][z], back[b][z] = v + s, (i, y)
        path, i, z = [], n, max(range(5), key=lambda y: score[n][y])
        while i > 0:
            a, y = back[i][z]
            if z != OUT:
                path.append((a, i, z))
            i, z = a, y
        return path[::-1]

    def sums(self, lat: Lattice):
        """(log of the partition sum, [(step start, step, marginal)],
        {(label, label): expected turns})."""
        steps, turns = self._steps(lat)
        n = len(lat.atoms)
        into = [[[] for _ in range(5)] for _ in range(n + 1)]
        into[0][OUT].append(0.0)
        alpha, enter = [None] * (n + 1), [None] * (n + 1)
        for i in range(n + 1):
            alpha[i] = [_lse(v) if v else -math.inf for v in into[i]]
            enter[i] = [_lse([alpha[i][y] + turns[y][z] for y in range(5)]) for z in range(5)]
            for b, z, s, _ in steps[i]:
                into[b][z].append(enter[i][z] + s)
        total = _lse(alpha[n])
        beta = [[-math.inf] * 5 for _ in range(n + 1)]
        beta[n] = [0.0] * 5
        expected, turned = [], Counter()
        for i in range(n - 1, -1, -1):
            leave = [[] for _ in range(5)]
            for step in steps[i]:
                b, z, s, _ = step
                rest = s + beta[b][z]
                p = math.exp(enter[i][z] + rest - total) if enter[i][z] > -math.inf and rest > -math.inf else 0.0
                expected.append((i, step, p))
                for y in range(5):
                    v = turns[y][z] + rest
                    leave[y].append(v)
                    if alpha[i][y] > -math.inf and v > -math.inf:
                        turned[y, z] += math.exp(alpha[i][y] + v - total)
            beta[i] = [_lse(v) if v else -math.inf for v in leave]
        return total, expected, turned

    def find(self, text: str, left: str, right: str, given: list, certain: float) -> list[tuple]:
        """Spans (kind, start, end) that the model adds to an island."""
        if len(text) <= WINDOW:
            return self.add(Lattice(text, left, right, given), certain)
        out, last, given = [], 0, sorted(given, key=lambda g: g[1])
        starts, longest = [g[1] for g in given], max((e - s for _, s, e in given), default=0)
        for core in range(0, len(text), WINDOW):
            a, b = max(0, core - MARGIN), min(len(text), core + WINDOW + MARGIN)
            near = given[bisect_left(starts, a - longest):bisect_left(starts, b)]
            lat = Lattice(text[a:b], text[a - 1] if a else left, text[b] if b < len(text) else right,
                          [(k, s - a, e - a) for k, s, e in near if e > a])
            for k, s, e in sorted(self.add(lat, certain), key=lambda x: x[1]):
                if core <= a + s < core + WINDOW and a + s >= last:
                    out.append((k, a + s, a + e))
                    last = a + e
        return out

    def add(self, lat: Lattice, certain: float) -> list[tuple]:
        """Free segments of the best path with a marginal of ``certain`` or
        more, as spans (kind, start, end) within the lattice's text."""
        if not any(k in self.kinds for _, _, k in lat.free):
            return []
        lat.segments = [s for s in lat.segments if s[2] in self.kinds or s[:3] in lat.fixed]
        free = set(lat.free)
        best = [s for s in self.best(lat) if s in free]
        if not best:
            return []
        sure = Counter()
        for i, (b, z, _, _), p in self.sums(lat)[1]:
            sure[i, b, z] += p
        return [lat.spans(s) for s in best if sure[s] >= certain]

    @classmethod
    def fit(cls, examples: list[tuple[Lattice, list[tuple]]], steps: int = 40, rate: float = 0.5, decay: float = 0.02) -> Field:
        """Trained on (lattice without given spans, gold segments): adaptive
        gradient steps on the mean log likelihood less a square penalty.
        Kinds without an example are never predicted."""
        gold, alike = [], Counter()
        shown = {}
        for lat, segments in examples:
            key = (tuple(map(str, lat.out)), tuple((a, b, k, *f) for a, b, k, f in lat.segments), tuple(segments))
            alike[key] += 1
            shown[key] = (lat, segments)
        field = cls({}, {k for _, segments in examples for _, _, k in segments})
        for lat, segments in shown.values():
            truth, at, y = Counter(), 0, OUT
            chosen = {a: (b, k) for a, b, k in segments}
            features = {(a, b, k): f for a, b, k, f in lat.segments}
            while at < len(lat.atoms):
                b, k = chosen.get(at, (at + 1, OUT))
                truth.update(lat.out[at] if k == OUT else features[at, b, k])
                truth[f"t{y}{k}"] += 1
                at, y = b, k
            gold.append(truth)
        many = list(alike.values())
        size = max(1, sum(many))
        names = {x for truth in gold for x in truth}
        names.update(x for lat, _ in shown.values() for _, _, _, f in lat.segments for x in f)
        names.update(x for lat, _ in shown.values() for f in lat.out for x in f or ())
        field.w = {x: -2.0 if x in KINDS else 0.0 for x in sorted(names)}
        seen = dict.fromkeys(field.w, 1e-8)
        for _ in range(steps):
            slope = {x: -decay * v for x, v in field.w.items()}
            for (lat, _), truth, n in zip(shown.values(), gold, many):
                share = n / size
                for x, c in truth.items():
                    slope[x] = slope.get(x, 0.0) + share * c
                _, expected, turned = field.sums(lat)
                for _, (_, _, _, f), p in expected:
                    for x in f:
                        slope[x] -= share * p
                for (y, z), p in turned.items():
                    slope[f"t{y}{z}"] = slope.get(f"t{y}{z}", 0.0) - share * p
            for x, g in slope.items():
                seen[x] = seen.get(x, 1e-8) + g * g
                field.w[x] = field.w.get(x, 0.0) + rate * g / math.sqrt(seen[x])
        return field


# --- islands ---------------------------------------------------------------

def islands(text: str, good: list, bad: list) -> Iterator[dict]:
    """Stretches of a text that hold a candidate or a base span: start, text,
    the characters beside it, base spans (relative), whether it holds a free
    candidate, and whether its labelling is beyond doubt: no free candidate
    lies within a longer match that a check dropped."""
    regions = [m.span() for m in _NUMBERS.finditer(text)
               if m.end() - m.start() >= 7 and sum("0" <= c <= "9" for c in m.group()) >= 4]
    regions += [m.span() for m in _ADDRESS.finditer(text)] if "@" in text else []
    regions += [(s, e) for _, s, e in good]
    merged: list[list[int]] = []
    for s, e in sorted(regions):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    good = sorted(good, key=lambda g: g[1])
    at = [g[1] for g in good]
    fails = [([b[1] for b in bad if b[0] == k], [b for b in bad if b[0] == k]) for k in (IP, CARD, PHONE)]

    def swallowed(x: int, y: int) -> bool:
        for starts, spans in fails:
            i = bisect_right(starts, x) - 1
            if i >= 0 and y <= spans[i][2] and (x, y) != spans[i][1:]:
                return True
        return False

    for s, e in merged:
        own = [(k, a - s, b - s) for k, a, b in good[bisect_left(at, s):bisect_left(at, e)]]
        part, left, right = text[s:e], text[s - 1:s] if s else "", text[e:e + 1]
        free, sure = True, False        # long ones are decoded by windows and never sampled
        if len(part) <= WINDOW:
            lat = Lattice(part, left, right, own)
            spans = [lat.spans(x) for x in lat.free]
            free, sure = bool(spans), not any(swallowed(s + x, s + y) for _, x, y in spans)
        if free or own:
            yield {"start": s, "text": part, "left": left, "right": right, "free": free, "sure": sure,
                   "base": [{"kind": k, "start": a, "stop": b} for k, a, b in own]}


_SPANS = "array<struct<kind:int,start:long,stop:long>>"
_ISLANDS = f"array<struct<start:long,text:string,left:string,right:string,free:boolean,sure:boolean,base:{_SPANS}>>"
_SPAN_T = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))
_ISLAND_T = pa.list_(pa.struct([("start", pa.int64()), ("text", pa.string()), ("left", pa.string()), ("right", pa.string()),
                                ("free", pa.bool_()), ("sure", pa.bool_()), ("base", _SPAN_T)]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches_of(batches, 256):
        base, found = [], []
        for text in b.column("text").to_pylist():
            good, bad = base_spans(text) if text and _SITE.search(text) else ([], [])
            base.append([{"kind": k, "start": s, "stop": e} for k, s, e in good])
            found.append(list(islands(text, good, bad)) if text and _SITE.search(text) else [])
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(base, _SPAN_T), pa.array(found, _ISLAND_T)],
                                         ["id", "base", "islands"])


def _find(weights: dict, kinds: set, certain: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights, kinds)
        kind_t = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
        for b in batches_of(batches, 256):
            out = []
            for base, found in zip(b.column("base").to_pylist(), b.column("islands").to_pylist()):
                spans = [(x["kind"], x["start"], x["stop"], True) for x in base]
                for x in found:
                    if x["free"]:
                        given = [(g["kind"], g["start"], g["stop"]) for g in x["base"]]
                        more = field.find(x["text"], x["left"], x["right"], given, certain)
                        spans += [(k, x["start"] + s, x["start"] + e, False) for k, s, e in more]
                out.append([{"kind": KINDS[k], "start": s, "stop": e, "base": old} for k, s, e, old in sorted(spans)])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, kind_t)], ["id", "spans"])
    return run


def examples(rows: list) -> list[tuple[Lattice, list[tuple]]]:
    """Training examples of sampled islands: each alone, and neighbours in
    the sample that are one base span each set side by side."""
    out, whole = [], []
    for r in rows:
        gold = [(x["kind"], x["start"], x["stop"]) for x in r["base"]]
        shown = _labelled(r["text"], r["left"], r["right"], gold)
        if shown:
            out.append(shown)
            if len(gold) == 1 and gold[0][1:] == (0, len(r["text"])) and gold[0][0] != EMAIL:
                whole.append((r["text"], gold[0][0]))
    for (a, j), (b, k) in zip(whole, whole[len(whole) // 2:] + whole[:len(whole) // 2]):
        shown = _labelled(f"{a} {b}", " ", " ", [(j, 0, len(a)), (k, len(a) + 1, len(a) + 1 + len(b))])
        if shown:
            out.append(shown)
    return out


def _labelled(text: str, left: str, right: str, gold: list) -> tuple | None:
    """(lattice, gold segments), or None where a gold span is no candidate."""
    lat = Lattice(text, left, right)
    by, gold = {lat.spans(x): x for x in lat.free}, sorted(gold, key=lambda g: g[1])
    if any(g not in by for g in gold) or any(a[2] > b[1] for a, b in zip(gold, gold[1:])):
        return None
    return lat, [by[g] for g in gold]


def personal_data(documents: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE,
                  certain: float = 0.9, report: dict | None = None) -> DataFrame:
    """One row (id, spans) per row of ``documents``: spans of type array of
    (kind, start, stop, base) by kind in the order of ``KINDS``, then start;
    positions count code points, ``stop`` is exclusive, ``base`` tells the
    patterns' spans from those that the model added.

    Base spans always stay; of one kind none overlap, of two kinds they may.
    An added span overlaps no base span and no other added one, and fits its
    kind's check.  The model learns from at most ``sample`` distinct islands
    per kind, and as many without personal data, of at most ``SAMPLE_CHARS``
    characters each, chosen by hash; kinds without an island in the sample
    are never added.  Null, empty and plain texts have no spans.  Rows are
    kept one by one, repeated and null ids included; other columns are
    ignored; an empty table gives an empty result.

    ``report``, when given, receives ``islands`` sampled and ``weights``.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "personal")
    d = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    read = scratch.save(d.mapInArrow(_read, f"id {kind}, base {_SPANS}, islands {_ISLANDS}"), "islands")
    seen = read.filter(F.size("islands") > 0).select(F.explode("islands").alias("i")).select("i.*")
    seen = seen.filter(F.col("sure") & (F.length("text") <= SAMPLE_CHARS))
    seen = seen.withColumn("kind", F.when(F.size("base") > 0, F.col("base")[0]["kind"]).otherwise(F.lit(OUT)))
    seen = scratch.save(seen.select("kind", "text", "left", "right", "base").distinct(), "distinct")
    rows = []
    for k in range(5):
        some = seen.filter(F.col("kind") == k).orderBy(F.xxhash64("text", "left", "right"), "text", "left", "right").limit(sample)
        rows += [r.asDict(recursive=True) for r in some.collect()]
    field = Field.fit(examples(rows))
    if report is not None:
        report.update(islands=len(rows), weights=field.w)
    return read.select("id", "base", "islands").mapInArrow(
        _find(field.w, field.kinds, certain), f"id {kind}, spans array<struct<kind:string,start:long,stop:long,base:boolean>>")
