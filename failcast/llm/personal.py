"""Personal data: candidate spans of high recall, judged by boosted trees.

Four base patterns (addresses of mail and of machines, card and phone numbers) give spans that
always stay. Generators propose further spans, overlapping each other and the base ones: spelled
out and international mail addresses, IPv6 and defanged addresses, cards and phone numbers inside
longer runs of digits, national phone numbers, other groups of digits. Each candidate has the
features of ``FEATURES``: its format (digits, separators, check sum, parts of an address) and its
context (cue words before it, what touches it). For each kind boosted trees, trained
here on the examples below, add up to a margin in whole numbers; a calibration on examples that were held
out turns margins into probabilities, and the threshold is the least margin from which held-out
candidates are right as often as ``PRECISION`` says.

Scanning is DataFrame functions alone, in one pass over the texts without a shuffle. Positions come
from the pieces between matches; running sums go through chunks, so a text of very many matches costs
little more than one of few. Patterns for Spark have possessive repeats and look back to the start of a run, which matches
the same in linear time. Features of context see the piece between two matches, at most ``BEFORE`` and ``AFTER`` characters of it.

Defined cases: a null or empty text has no spans; each row gives a row, whatever its id; spans
are in code points, the end exclusive; a span found twice is one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.llm.common import LOWER, UPPER, documents, whole_text

KINDS = ("email", "ip", "card", "phone")
BEFORE, AFTER = 24, 8
TREES, DEPTH, RATE, LEAST_LEAF = 24, 3, 0.3, 6
PRECISION = 0.98
CHUNK = 256


class Pattern(NamedTuple):
    kind: str
    plain: str
    #: What a text with a match has for certain, as SQL: a cheap test that spares most texts the pattern.
    needs: str
    #: The same matches for an engine that tracks back; '' where the plain one is linear there too.
    linear: str = ""

    @property
    def java(self) -> str:
        return self.linear or self.plain


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_ANY, _ANY_LABEL = "[A-Za-z0-9._%+\x80-\U0010ffff-]", "[A-Za-z0-9\x80-\U0010ffff-]"
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _from_run_start(run: str) -> str:
    """Where a match may start: at the start of a run of ``run``, or right after the last match."""
    return rf"(?:\G|(?<!{run})){run}++"


def _has(*parts: str) -> str:
    return "(" + " OR ".join(f"contains(text, '{p}')" for p in parts) + ")"


_MAIL, _PLUS, _DIGIT, _RUN = _has("@"), _has("+"), "some_digit", "some_run"
#: Tests on digits that several patterns share: any, and 14 with at most two separators between neighbours.
_SHARED = {_DIGIT: "[0-9]", _RUN: r"[0-9](?:[./_\x20-]{0,2}[0-9]){13}"}
_CLOSED = [f"{at}{by}" for at in ("at", "AT", "At", "@") for by in "])}"]

# The base patterns, each with its own checks below.
BASE = (
    Pattern("email", rf"{_LOCAL}+@{_LABEL}+(?:\.{_LABEL}+)+", _MAIL, rf"{_from_run_start(_LOCAL)}@{_LABEL}++(?:\.{_LABEL}++)++"),
    Pattern("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", _DIGIT, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Pattern("card", r"[0-9](?:[\x20-]?[0-9])+", _RUN, r"[0-9](?:[\x20-]?+[0-9])++"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _PLUS),
)

_AT, _DOT = r"\x20?[\[({](?:at|AT|At|@)[\])}]\x20?", r"\x20?[\[({](?:dot|DOT|Dot|\.)[\])}]\x20?"

# The generators of further candidates.
GENERATORS = (
    Pattern("email", rf"{_LOCAL}+{_AT}{_LABEL}+(?:{_DOT}{_LABEL}+|\.{_LABEL}+)+", _has(*_CLOSED), rf"{_from_run_start(_LOCAL)}{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++|\.{_LABEL}++)++"),
    Pattern("email", rf"{_LOCAL}+\x20(?:at|AT)\x20{_LABEL}+(?:\x20(?:dot|DOT)\x20{_LABEL}+)+", _has(" dot ", " DOT "), rf"{_from_run_start(_LOCAL)}\x20(?:at|AT)\x20{_LABEL}++(?:\x20(?:dot|DOT)\x20{_LABEL}++)++"),
    Pattern("email", rf"{_LOCAL}+\x20@\x20{_LABEL}+(?:\.{_LABEL}+)+", _has(" @ "), rf"{_from_run_start(_LOCAL)}\x20@\x20{_LABEL}++(?:\.{_LABEL}++)++"),
    Pattern("email", rf"{_ANY}+@{_ANY_LABEL}+(?:\.{_ANY_LABEL}+)+", _MAIL, rf"{_from_run_start(_ANY)}@{_ANY_LABEL}++(?:\.{_ANY_LABEL}++)++"),
    Pattern("ip", r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}", _has(":")),
    Pattern("ip", r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\x20\.\x20|\x20dot\x20)[0-9]{1,3}){3}", _has("[.]", "(.)", "[dot]", "(dot)", " . ", " dot ")),
    Pattern("card", r"[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}", _RUN),
    Pattern("card", r"[0-9]{4}[\x20.-]?[0-9]{6}[\x20.-]?[0-9]{4,5}", _RUN),
    Pattern("card", r"[0-9]{4}[./_\x20-]{1,2}[0-9]{4}[./_\x20-]{1,2}[0-9]{4}[./_\x20-]{1,2}[0-9]{4}", _RUN),
    Pattern("phone", r"\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}", _DIGIT),
    Pattern("phone", r"\+1[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}", _PLUS),
    Pattern("phone", r"\+[1-9][0-9]{0,2}(?:[\x20.-][0-9]{2,5}){2,4}", _PLUS),
    Pattern("phone", r"00[1-9][0-9]{0,2}[\x20().0-9-]{5,14}[0-9]", _has("00")),
    Pattern("phone", r"[0-9]{2,5}(?:[\x20./-][0-9]{2,5}){1,4}", _DIGIT),
    Pattern("phone", r"[0-9]{7,12}", _DIGIT),
)

# Words before a candidate that speak for its kind, and those right before it that speak against any.
CUES = {
    "email": r"(?:mail|contact|write|reach|address)",
    "ip": r"(?:(?:^|[^a-z0-9])ip(?:v[46])?(?:[^a-z0-9]|\z)|addr|host|server|ping|login|client)",
    "card": r"(?:card|visa|master|amex|credit|debit|carte|karte|tarjeta|paid|pay)",
    "phone": r"(?:tel|phone|call|fax|mobile|cell|sms|whatsapp|dial|ring|anruf|llama)",
}
AGAINST = r"(?:^|[^a-z])(?:order|invoice|version|isbn|issn|part|build|ref|serial|ticket|token|hash|page|chapter|section|row|id|no|nr|number|price|cost|eur|usd|date|on|since|in|key|mac|at)[^a-z0-9]*\z"
TOUCHING_LEFT = r"[0-9A-Za-z._/@:=\x22-]\z"
TOUCHING_RIGHT = r"^(?:[0-9A-Za-z_@%:=\x22/-]|\.[0-9])"
QUAD = rf"^{_OCTET}(?:[^0-9A-Fa-f:]+{_OCTET}){{3}}\z"
DOMAIN = r"(?:com|org|net|edu|gov|io|de|fr|es|uk|co|info|eu)\z"
WIDE = "[\x80-\U0010ffff]"

FEATURES = ("generator", "digits", "chars", "letters", "separators", "colons", "luhn", "quad", "cue", "against", "left", "right", "opens", "domain", "bracket", "wide")


def luhn(digits: str) -> int:
    if not 12 <= len(digits) <= 19:
        return 0
    doubled = (int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return int(sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0)


def features_of(generator: int, s: str, before: str, after: str) -> list[int]:
    """``FEATURES`` of one candidate, for training."""
    has = lambda pattern, x: int(re.search(pattern.replace(r"\z", r"\Z"), x) is not None)
    lower = before.translate(str.maketrans(UPPER, LOWER))
    digits = re.sub("[^0-9]", "", s)
    counts = [len(digits), len(s), len(re.sub("[^A-Za-z]", "", s)), len(re.findall("[^0-9A-Za-z]+", s)), s.count(":")]
    opens = has(r"^(?:\+|00|\()", s)
    return [generator, *counts, luhn(digits), has(QUAD, s), has(CUES[GENERATORS[generator].kind], lower), has(AGAINST, lower), has(TOUCHING_LEFT, before), has(TOUCHING_RIGHT, after), opens, has(DOMAIN, s.lower() if s.isascii() else s), has(r"[\[({]", s), has(WIDE, s)]


def candidates_in(text: str, kind: str) -> list[tuple[int, int, int, list[int]]]:
    """(generator, start, end, features) of all candidates of one text, for training and tests."""
    out = []
    for g, pattern in enumerate(GENERATORS):
        if pattern.kind != kind:
            continue
        found = [m.span() for m in re.finditer(pattern.plain, text)]
        for i, (a, b) in enumerate(found):
            left = text[found[i - 1][1] if i else 0 : a]
            right = text[b : found[i + 1][0] if i + 1 < len(found) else len(text)]
            out.append((g, a, b, features_of(g, text[a:b], left[-BEFORE:], right[:AFTER])))
    return out


# Words that examples are made of.
FILLER = "time people way water day place week point home room area money story fact month lot study book eye job word side kind head house friend father hour game line end city name the a of with and from we they left after noon look arrive".split()
HOSTS, ENDS = "mail example host acme uni web shop post".split(), "com org net de fr es io".split()


def _examples(rng: random.Random, kind: str, n: int) -> list[tuple[str, int, int]]:
    """(text, start, end) with the span of a true value of the kind, or (text, -1, -1)."""
    pick, number = rng.choice, lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    group = lambda *sizes, by=" ": by.join(number(k) for k in sizes)
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    octet = lambda: str(rng.randint(0, 255))
    word = lambda: pick(FILLER)

    def paid(size: int) -> str:
        while True:
            digits = pick("3456") + number(size - 1)
            if luhn(digits):
                return digits

    def cut(digits: str, sizes: tuple[int, ...], by: str) -> str:
        ends = np.cumsum(sizes)
        return by.join(digits[e - k : e] for e, k in zip(ends, sizes, strict=True))

    cues = {"email": ["mail ", "contact: ", "write to ", "e-mail ", "reach me "], "ip": ["ip ", "address ", "host ", "server: ", "IP: ", "ping "], "card": ["card ", "visa: ", "credit card ", "amex ", "paid with "], "phone": ["tel ", "phone: ", "call ", "Tel.: ", "fax ", "mobile "]}[kind]
    person = lambda: pick([word() + "." + word(), word() + number(2), word() + "_" + word()])
    host, end = lambda: pick(HOSTS) + pick(["", number(1)]), lambda: pick(ENDS)
    nanp = lambda: pick([f"({number(3)}) {number(3)}-{number(4)}", group(3, 3, 4, by="-"), group(3, 3, 4, by=".")])
    true = {
        "email": [
            lambda: f"{person()}{pick([' [at] ', '[at]', ' (at) ', '(at)', '{at}'])}{host()}{pick([' [dot] ', '[dot]', '(dot)', '.'])}{end()}",
            lambda: f"{person()} at {host()} dot {end()}",
            lambda: f"{person()} @ {host()}.{end()}",
            lambda: f"{pick('éüñß')}{person()}@{host()}.{end()}",
            lambda: f"{person()}{pick('éüñß')}@{pick('éüñ')}{host()}.{end()}",
        ],
        "ip": [
            lambda: ":".join(hexes(rng.randint(1, 4)) for _ in range(8)),
            lambda: "2001:db8:" + ":" + ":".join(hexes(4) for _ in range(rng.randint(2, 4))),
            lambda: pick(["fe80::", "2a00::"]) + ":".join(hexes(4) for _ in range(rng.randint(2, 4))),
            lambda: pick(["[.]", "(.)", "[dot]", " . "]).join(octet() for _ in range(4)),
        ],
        "card": [
            lambda: cut(paid(16), (4, 4, 4, 4), pick([" ", "-", ""])),
            lambda: cut(paid(15), (4, 6, 5), pick([" ", "-", "", "."])),
            lambda: cut(paid(16), (4, 4, 4, 4), pick([".", "/", "  ", "_"])),
        ],
        "phone": [nanp, lambda: "+1 " + nanp(), lambda: "00" + pick(["49", "33", "34"]) + " " + group(2, 3, 4), lambda: "+" + pick(["49", "33", "34"]) + " " + group(2, 3, 4)],
    }[kind]
    # Values that only a cue before them tells apart.
    told = {"card": [lambda: cut(number(16), (4, 4, 4, 4), pick([" ", "-", ""]))], "phone": [lambda: "0" + number(9), lambda: group(3, 3, 4), lambda: group(3, 4), lambda: "0" + group(3, 6, by="/")]}.get(kind, [])
    other = [
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 31)}",
        lambda: f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
        lambda: ":".join(hexes(2) for _ in range(6)),
        lambda: ".".join(number(1) for _ in range(rng.randint(3, 6))),
        lambda: ".".join(octet() for _ in range(4)),
        lambda: pick(["order ", "order no. ", "token ", "serial ", "ref ", "", ""]) + number(rng.randint(7, 18)),
        lambda: "token = \"" + hexes(32) + "\"",
        lambda: pick(["ISBN ", "isbn: "]) + pick([group(3, 1, 2, 6, 1, by="-"), number(13)]),
        lambda: group(*[rng.randint(1, 4) for _ in range(rng.randint(2, 6))]),
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}",
        lambda: f"{number(2)}.{number(rng.randint(4, 9))}",
        lambda: f"{word()} at {word()} dot {word()}",
        lambda: f"{word()} at {word()} {word()}",
        lambda: f"{word()}@{word()}",
        lambda: group(4, 4, 4, 4),
        lambda: number(16),
        lambda: cut(number(16), (4, 4, 4, 4), pick([".", "/", "_"])),
        lambda: "$" + group(3, 3, 3, by=pick([",", " "])),
    ]
    if kind != "phone":
        other.append(lambda: "+1 " + nanp())
    if kind != "card":
        other += [lambda: cut(paid(16), (4, 4, 4, 4), pick([" ", "-", ""]))] * 2
    out = []
    for _ in range(n):
        left, right = " ".join(word() for _ in range(rng.randint(0, 5))), " ".join(word() for _ in range(rng.randint(0, 4)))
        left = left + " " if left else ""
        roll = rng.random()
        if roll < 0.4 or (roll < 0.5 and not told):
            left += pick(cues) if rng.random() < 0.4 else ""
            if kind == "card" and rng.random() < 0.3:
                right = number(2) + "/" + number(2) + " " + right  # the base pattern runs on into what follows
            elif kind == "phone" and rng.random() < 0.3:
                right = ".".join(octet() for _ in range(4)) + " " + right
            value, is_true = pick(true)(), True
        elif roll < 0.5:
            left, value, is_true = left + pick(cues), pick(told)(), True
        else:
            left += pick(["", "", "", "page ", "version ", "on ", "no. ", "id "])
            value, is_true = pick(other)(), False
        text = left + value + pick([" ", ". ", ", "] if is_true else [" ", ". ", ", ", ""]) + right
        out.append((text, len(left), len(left) + len(value)) if is_true else (text, -1, -1))
    return out


Tree = tuple  # (feature, least value of the right side, left, right) or a whole number


def _tree(x: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, depth: int) -> Tree | int:
    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + 1.0)

    best, total_g, total_h = (1e-6, None, None), gradient.sum(), curvature.sum()
    for f in range(x.shape[1]) if depth else ():
        values, place = np.unique(x[:, f], return_inverse=True)
        if len(values) > 1:
            n, g, h = (np.cumsum(np.bincount(place, weights=w))[:-1] for w in (np.ones(len(x)), gradient, curvature))
            gains = np.where((n >= LEAST_LEAF) & (len(x) - n >= LEAST_LEAF), gain(g, h) + gain(total_g - g, total_h - h) - gain(total_g, total_h), 0)
            k = int(gains.argmax())
            if gains[k] > best[0]:
                best = (gains[k], f, int(values[k + 1]))
    if best[1] is None:
        return round(1000 * RATE * total_g / (total_h + 1.0))
    right = x[:, best[1]] >= best[2]
    return best[1], best[2], _tree(x[~right], gradient[~right], curvature[~right], depth - 1), _tree(x[right], gradient[right], curvature[right], depth - 1)


def margin_of(tree: Tree | int, row) -> int:
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] >= tree[1] else tree[2]
    return tree


class Model(NamedTuple):
    trees: tuple
    #: The least margin of a span that is taken, and the calibration p = 1 / (1 + exp(-(slope * margin / 1000 + start))).
    least: int
    slope: float
    start: float


@lru_cache(maxsize=1)
def trained() -> dict[str, Model]:
    """The trees of each kind, the same on every machine."""
    out = {}
    for kind in KINDS:
        rng = random.Random(f"personal {kind}")

        def judged(n: int) -> tuple[np.ndarray, np.ndarray]:
            # Parts of a true span are neither right nor wrong.
            found = [(row, (a, b) == (start, end)) for text, start, end in _examples(rng, kind, n) for _, a, b, row in candidates_in(text, kind) if not (start <= a and b <= end and b - a < end - start)]  # noqa: B023
            return np.array([row for row, _ in found]), np.array([y for _, y in found], float)

        x, y = judged(3000)
        margin, trees = np.zeros(len(x)), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin / 1000))
            trees.append(_tree(x, y - p, p * (1 - p), DEPTH))
            margin += np.array([margin_of(trees[-1], row) for row in x.tolist()])
        hx, hy = judged(1000)
        held = np.array([sum(margin_of(t, row) for t in trees) for row in hx.tolist()])
        slope, start = 1.0, 0.0
        for _ in range(20):  # Newton steps of a logistic curve over the held-out margins
            z = slope * held / 1000 + start
            p = 1 / (1 + np.exp(-z))
            w, r = p * (1 - p) + 1e-6, hy - p
            m = held / 1000
            a, b, c = (w * m * m).sum() + 1e-3, (w * m).sum(), w.sum() + 1e-3
            g0, g1 = (r * m).sum() - 1e-3 * slope, r.sum() - 1e-3 * start
            slope, start = slope + (c * g0 - b * g1) / (a * c - b * b), start + (a * g1 - b * g0) / (a * c - b * b)
        # The least margin from which on a probability of one half is passed and so is the wanted precision.
        even = math.ceil(-1000 * start / slope) if slope > 0 else 0
        levels = sorted({int(v) for v in held if v >= even})
        least = next((v for v in levels if hy[held >= v].mean() >= PRECISION), (levels or [even])[-1])
        out[kind] = Model(tuple(trees), least, slope, start)
    return out


def _tree_sql(tree: Tree | int, names: list[str]) -> str:
    if not isinstance(tree, tuple):
        return str(tree)
    return f"CASE WHEN {names[tree[0]]} >= {tree[1]} THEN {_tree_sql(tree[3], names)} ELSE {_tree_sql(tree[2], names)} END"


def margin_sql(kind: str, prefix: str = "") -> str:
    names = [prefix + f for f in FEATURES]
    return " + ".join(f"({_tree_sql(t, names)})" for t in trained()[kind].trees)


def _raw(pattern: str) -> str:
    return f"r'{pattern}'"


def _let(value: str, name: str, use: str) -> str:
    """``use`` of a value that is computed once, under a name."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _fold(steps: str, start: str) -> str:
    state = "named_struct('upto', {0}, 'sums', {1})"
    return f"aggregate({steps}, {state.format(start, 'CAST(array() AS ARRAY<INT>)')}, (z, v) -> {state.format('z.upto + v', 'array_append(z.sums, z.upto)')}, z -> z.sums)"


def _running(steps: str) -> str:
    """The sum of all earlier steps, for each step; through chunks, as an array grows by copying."""
    chunks = f"transform(sequence(0, CAST(floor((size(st) - 1) / {CHUNK}) AS INT)), k -> slice(st, k * {CHUNK} + 1, {CHUNK}))"
    totals = "transform(ch, x -> aggregate(x, 0, (t, v) -> t + v))"
    return _let(steps, "st", _let(chunks, "ch", f"flatten(zip_with(ch, {_fold(totals, '0')}, (x, o) -> {_fold('x', 'o')}))"))


def matches_sql(pattern: Pattern, text: str = "text") -> str:
    """SQL for array<struct<start int, s, before, after string>> of all matches in order; null where there is none."""
    row = f"named_struct('start', get(w, i) + char_length(get(p, i)), 's', s, 'before', right(get(p, i), {BEFORE}), 'after', left(get(p, i + 1), {AFTER}))"
    steps = "transform(m, (s, i) -> char_length(get(p, i)) + char_length(s))"
    placed = _let(f"split({text}, {_raw(pattern.java)}, -1)", "p", _let(_running(steps), "w", f"transform(m, (s, i) -> {row})"))
    return _let(f"regexp_extract_all({text}, {_raw(pattern.java)}, 0)", "m", f"CASE WHEN size(m) > 0 THEN {placed} END")


def _code_sql(kind: str, match: str) -> str:
    """Kind, start and length in one number, in whose order spans are listed."""
    return f"({KINDS.index(kind) << 61}L + CAST({match}.start AS BIGINT) * {1 << 30}L + char_length({match}.s))"


def _digits_sql(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def _luhn_sql(s: str) -> str:
    value = "CAST(substring(d, i, 1) AS INT)"
    total = f"aggregate(sequence(1, char_length(d)), 0, (t, i) -> t + CASE WHEN (char_length(d) - i) % 2 = 1 THEN {value} * 2 - CASE WHEN {value} > 4 THEN 9 ELSE 0 END ELSE {value} END)"
    return _let(_digits_sql(s), "d", f"CASE WHEN char_length(d) BETWEEN 12 AND 19 THEN CAST({total} % 10 = 0 AS INT) ELSE 0 END")


def _valid_sql(kind: str, s: str) -> str:
    """The checks of the base patterns."""
    n = f"char_length({_digits_sql(s)})"
    octets = _raw(rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z")
    return {"email": "true", "ip": f"{s} RLIKE {octets}", "card": f"{n} BETWEEN 16 AND 19 AND {_luhn_sql(s)} = 1", "phone": f"{n} BETWEEN 8 AND 15"}[kind]


def _features_sql(g: int) -> str:
    """SQL for the code and the features of a match ``c`` of generator ``g``."""
    kind = GENERATORS[g].kind
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    has = lambda x, pattern: f"CAST({x} RLIKE {_raw(pattern)} AS INT)"
    count = lambda pattern: f"regexp_count(c.s, {_raw(pattern)})"
    before = lower("c.before")
    made = [str(g), f"char_length({_digits_sql('c.s')})", "char_length(c.s)", "char_length(regexp_replace(c.s, '[^A-Za-z]', ''))", count("[^0-9A-Za-z]+"), count(":"), _luhn_sql("c.s"), has("c.s", QUAD), has(before, CUES[kind]), has(before, AGAINST)]
    made += [has("c.before", TOUCHING_LEFT), f"coalesce({has('c.after', TOUCHING_RIGHT)}, 0)", has("c.s", r"^(?:\+|00|\()")]
    made += [has(f"CASE WHEN c.s RLIKE {_raw(WIDE)} THEN c.s ELSE {lower('c.s')} END", DOMAIN), has("c.s", r"[\[({]"), has("c.s", WIDE)]
    return f"named_struct('code', {_code_sql(kind, 'c')}, {', '.join(f'{chr(39)}{f}{chr(39)}, {v}' for f, v in zip(FEATURES, made, strict=True))})"


def found_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_email, n_ip, n_card, n_phone, base array<long>, spans array<long>): spans as codes, in order."""
    plain = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    plain = plain.withColumns({name: F.expr(f"text RLIKE {_raw(pattern)}") for name, pattern in _SHARED.items()})
    none = "CAST(array() AS ARRAY<BIGINT>)"
    made = {}
    for p in BASE:
        codes = f"transform(filter({matches_sql(p)}, c -> {_valid_sql(p.kind, 'c.s')}), c -> {_code_sql(p.kind, 'c')})"
        made[f"base_{p.kind}"] = F.expr(f"coalesce(CASE WHEN {p.needs} THEN {codes} END, {none})")
    for g, p in enumerate(GENERATORS):
        made[f"cand_{g}"] = F.expr(f"CASE WHEN {p.needs} THEN transform({matches_sql(p)}, c -> {_features_sql(g)}) END")
    seen = plain.withColumns(made)
    taken = [F.expr(f"coalesce(transform(filter(cand_{g}, c -> {margin_sql(p.kind, 'c.')} >= {trained()[p.kind].least}), c -> c.code), {none})") for g, p in enumerate(GENERATORS)]
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    own = F.concat(*[F.col(f"base_{k}") for k in KINDS])
    return seen.select("doc_id", "text", *counts, own.alias("base"), F.array_sort(F.array_distinct(F.concat(own, *taken))).alias("spans"))


def _part(code: Column) -> tuple[Column, Column, Column]:
    """Kind's number, start and end of a code."""
    start = F.shiftright(code, 30).bitwiseAND(F.lit((1 << 31) - 1))
    return F.shiftright(code, 61).cast("int"), start, start + code.bitwiseAND(F.lit((1 << 30) - 1))


def listed(codes: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def one(code: Column) -> Column:
        kind, start, end = _part(code)
        return F.concat_ws(":", F.get(names, kind), start.cast("string"), end.cast("string"))

    return F.array_join(F.transform(codes, one), ",")


def redacted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_spans): texts with every span replaced by its kind in brackets; spans that overlap are replaced once, by the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def span(code: Column) -> Column:
        kind, start, end = _part(code)
        return F.struct(start.cast("int").alias("start"), (-end).cast("int").alias("back"), kind.alias("kind"))

    def step(state: Column, x: Column) -> Column:
        piece = F.concat(F.substring(F.col("text"), state["at"] + 1, x["start"] - state["at"]), F.get(names, x["kind"]))
        return F.struct(F.greatest(state["at"], -x["back"]).alias("at"), F.when(x["start"] >= state["at"], F.array_append(state["out"], piece)).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    end = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.char_length("text")))
    spans = found_spans(docs, id_col=id_col, text_col=text_col)
    return spans.select("doc_id", F.aggregate(F.array_sort(F.transform("spans", span)), start, step, end).alias("text"), F.size("spans").cast("long").alias("n_spans"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_spans(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def oracle_sql() -> str:
    """The scan as DuckDB SQL, with the trees as CASE expressions."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    count = lambda cls: f"length(regexp_replace(s, {quote(cls)}, '', 'g'))"
    has = lambda x, pattern: f"regexp_matches({x}, {quote(pattern)})::INTEGER"
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    luhn_sql = "CASE WHEN length(d) BETWEEN 12 AND 19 AND list_sum([CASE WHEN (length(d) - i) % 2 = 1 THEN d[i]::INTEGER * 2 - CASE WHEN d[i]::INTEGER > 4 THEN 9 ELSE 0 END ELSE d[i]::INTEGER END FOR i IN range(1, length(d) + 1)]) % 10 = 0 THEN 1 ELSE 0 END"

    def spans(p: Pattern, extra: str) -> str:
        return f"""SELECT rid, {KINDS.index(p.kind)} AS kind, s, regexp_replace(s, '[^0-9]', '', 'g') AS d, before, after, start, start + length(s) AS stop, {extra}
  FROM (SELECT rid, m[i] AS s, right(p[i], {BEFORE}) AS before, left(p[i + 1], {AFTER}) AS after,
               list_sum([length(x) FOR x IN p[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS start
        FROM (SELECT rid, m, p, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT rid, regexp_extract_all(text, {quote(p.plain)}) AS m, string_split_regex(text, {quote(p.plain)}) AS p FROM texts)))"""

    base = "\n  UNION ALL ".join(spans(p, "0 AS generator") for p in BASE)
    further = "\n  UNION ALL ".join(spans(p, f"{g} AS generator") for g, p in enumerate(GENERATORS))
    valid = f"CASE kind WHEN 0 THEN true WHEN 1 THEN regexp_matches(s, {quote(rf'^{_OCTET}(?:\.{_OCTET}){{3}}\z')}) WHEN 2 THEN length(d) BETWEEN 16 AND 19 AND {luhn_sql} = 1 ELSE length(d) BETWEEN 8 AND 15 END"
    cue = "CASE kind " + " ".join(f"WHEN {i} THEN {has(lower('before'), CUES[k])}" for i, k in enumerate(KINDS)) + " END"
    wide = f"regexp_matches(s, {quote(WIDE)})"
    made = ["generator", "length(d)", "length(s)", count("[^A-Za-z]"), "len(regexp_extract_all(s, '[^0-9A-Za-z]+'))", "len(regexp_extract_all(s, ':'))", luhn_sql, has("s", QUAD), cue, has(lower("before"), AGAINST), has("before", TOUCHING_LEFT), has("after", TOUCHING_RIGHT), has("s", r"^(?:\+|00|\()")]
    made += [has(f"CASE WHEN {wide} THEN s ELSE {lower('s')} END", DOMAIN), has("s", r"[\[({]"), f"{wide}::INTEGER"]
    features = ", ".join(f"{v} AS f_{f}" for v, f in zip(made, FEATURES, strict=True))
    taken = " ".join(f"WHEN {i} THEN {margin_sql(k, 'f_')} >= {trained()[k].least}" for i, k in enumerate(KINDS))
    names = ", ".join(quote(k) for k in KINDS)
    listed_sql = f"string_agg(([{names}])[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY kind, start, stop)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(KINDS))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
based AS (SELECT rid, kind, start, stop FROM (
  {base}) WHERE {valid}),
candidates AS (
  {further}),
featured AS (SELECT rid, kind, start, stop, {features} FROM candidates),
added AS (SELECT rid, kind, start, stop FROM featured WHERE CASE kind {taken} END),
per_base AS (SELECT rid, {counts}, {listed_sql} AS base FROM based GROUP BY rid),
per_all AS (SELECT rid, {listed_sql} AS spans FROM (SELECT * FROM based UNION SELECT * FROM added) GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_base USING (rid) LEFT JOIN per_all USING (rid)
"""
