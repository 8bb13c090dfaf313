"""Personal data by a semi-Markov conditional random field over candidate segments.

Four kinds are looked for: ``email``, ``ip``, ``card`` and ``phone``. Patterns give the base spans. They miss spans that run
into other digits, and those written in other ways, so a text's stretches of digits and its ``@`` signs are *islands*
that a model segments: every stretch of tokens that might be a whole entity is a candidate, whose features look at
the whole of it (grouping of digits, check digit, separators, the words around it). Segments are scored
together with the kinds of their neighbours. Entities have at most ``MAX_TOKENS`` tokens, so the dynamic
program that chooses boundaries and kinds jointly takes a bounded number of steps per token. Outside islands there are no candidates, and islands lie
apart, so the best segmentation of a text is that of its islands.

The model is trained by maximum likelihood (forward-backward sums over all segmentations) on generated
entities and look-alikes, set into words of a bounded sample of the documents.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
MAX_TOKENS = 40
SPANS = "array<struct<kind:string,start:long,end:long>>"

# Rows whose words surround the entities of the training set, and the length of the stretch taken from each.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 400
TRAINING_ISLANDS = 2000
ROUNDS = 100

# The patterns of the base spans. Possessive and anchored forms take the same spans in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The stretches that hold the spans of digits.
DIGITS = re.compile(r"[+(]?[0-9](?:[0-9 ().+-]*[0-9])?")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

AT_SIGN = re.compile(r"@|\(at\)|\[at\]", re.IGNORECASE)
LOOSE_MAIL = re.compile(
    r"[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9])){0,63} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]{1,63})+",
    re.IGNORECASE,
)
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
PHONE_SHAPE = re.compile(r"\+?\(?[0-9]+(?:(?:\) ?|[ .-]| \(|-\()[0-9]+)*")
CARD_SHAPE = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
WORD = re.compile(r"[^\W\d_]+")

# Words that speak for a kind, or for a number of another sort, if one of them stands shortly before.
CUES = {
    "phone": "call fax handy mobile phone tel telefon telefono telefone telephone whatsapp",
    "card": "amex card carte credit debit karte kreditkarte mastercard tarjeta visa",
    "ip": "address addr host ip ipv server",
    "email": "contact email mail",
    "other": "article build date id invoice isbn no nr number order part ref reference release section sku token tracking v version",
}
CUE_OF = {word: kind for kind, words in CUES.items() for word in words.split()}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _is_part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the spans the patterns give, sorted. Matches of each kind do not overlap."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    for island in DIGITS.finditer(text):
        lo, hi = island.span()
        if hi - lo < 7:
            continue
        part = island[0]
        if part.count(".") > 2:
            found += [(m.start(), 1, m.end()) for m in IP.finditer(text, lo, hi) if all(map(_is_part, m.groups()))]
        if hi - lo < 10:
            continue
        for m in CARD.finditer(text, lo, hi):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in part:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text, lo, hi) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Disjoint stretches of a text in which entities may lie."""
    spans = [m.span() for m in DIGITS.finditer(text) if m.end() - m.start() > 6]
    for sign in AT_SIGN.finditer(text):
        lo = max(0, sign.start() - 80)
        lo = max(lo, text.rfind(" ", lo, max(sign.start() - 1, 0)) + 1)
        spans.append((lo, min(sign.end() + 120, len(text))))
    spans.sort()
    out: list[tuple[int, int]] = []
    for lo, hi in spans:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    yield from out


@dataclass
class Lattice:
    """The candidates of one island: ``(first token, last token + 1, kind, features)``, and the bounds of its tokens."""

    bounds: list[int]
    segments: list[tuple[int, int, int, tuple[str, ...]]] = field(default_factory=list)


def _context(text: str, start: int, end: int) -> list[str]:
    """What stands before and after a candidate."""
    before, after = text[max(0, start - 2) : start], text[end : end + 2]
    out = []
    for side, near, far in (("left", before[-1:], before[:-1]), ("right", after[:1], after[1:])):
        if near.isdigit() or (near and near in " .-)(" and far.isdigit()):
            kind = "digit"
        elif near.isalpha() or near == "_":
            kind = "letter"
        elif not near or near.isspace():
            kind = "space"
        else:
            kind = "joint" if near in ".-/:=#@+" and far and not far.isspace() else "mark"
        out.append(f"{side}={kind}")
    cues = {CUE_OF.get(w.lower()) for w in WORD.findall(text[max(0, start - 24) : start])} - {None}
    return [*out, *(f"cue={c}" for c in sorted(cues))]


def _number_features(text: str, start: int, end: int, kind: int) -> tuple[str, ...]:
    part = text[start:end]
    groups = re.findall(r"[0-9]+", part)
    digits = "".join(groups)
    separators = sorted({s.strip() or "_" for s in re.findall(r"[^0-9]+", part.lstrip("+("))})
    own = [f"digits={len(digits)}", f"shape={'-'.join(str(len(g)) for g in groups) if len(groups) < 6 else 'many'}", f"separators={''.join(separators)}"]
    if len(separators) > 1 and kind != 3:
        own.append("mixed")
    if kind == 1:
        own += [f"zeros={any(len(g) > 1 and g[0] == '0' for g in groups)}"]
    elif kind == 2:
        own += [f"luhn={luhn(digits)}", f"issuer={digits[0] in '3456'}"]
    else:
        own += [f"opens={part[0] if part[0] in '+(' else 'digit'}", f"year={len(groups[0]) == 4 and groups[0][:2] in ('19', '20')}", f"short={len(digits) < 9}"]
    name = KINDS[kind]
    return tuple(f"{name}:{f}" for f in ["any", *own, *_context(text, start, end)])


def _mail_features(text: str, start: int, end: int, mail: re.Match) -> tuple[str, ...]:
    part = text[start:end].lower()
    last = re.split(r"\.|\)|\] ?", part)[-1].strip()
    own = [
        f"sign={'plain' if '@' in part else 'spelt'}",
        f"spaced={' ' in part}",
        f"last={'letters' if last.isalpha() else 'other'}{min(len(last), 5)}",
        f"whole={start == mail.start() and end == mail.end()}",
    ]
    return tuple(f"email:{f}" for f in ["any", *own, *_context(text, start, end)])


def lattice(text: str, lo: int, hi: int, taken: list[tuple[int, int]]) -> Lattice:
    """All candidates between ``lo`` and ``hi`` that touch no ``taken`` span."""
    bounds = [lo, *(m.end() for m in TOKEN.finditer(text, lo, hi))]
    out = Lattice(bounds)
    n = len(bounds) - 1
    blocked = [False] * n
    for a, b in taken:
        for k in range(max(bisect_right(bounds, a) - 1, 0), min(bisect_left(bounds, b), n)):
            blocked[k] = True
    place = {b: k for k, b in enumerate(bounds)}
    for i in range(n):
        opens = text[bounds[i]]
        if blocked[i] or not (opens in "+(" or opens.isdecimal()):
            continue
        digits = 0
        for j in range(i + 1, min(i + MAX_TOKENS, n) + 1):
            token = text[bounds[j - 1] : bounds[j]]
            if blocked[j - 1] or not (token.isdecimal() or token in "+().- "):
                break
            if not token.isdecimal():
                continue
            digits += len(token)
            if digits > 19:
                break
            part = text[bounds[i] : bounds[j]]
            if digits < 13 and j - i == 7 and QUAD.fullmatch(part) and all(map(_is_part, part.split("."))):
                out.segments.append((i, j, 1, _number_features(text, bounds[i], bounds[j], 1)))
            if digits > 11 and CARD_SHAPE.fullmatch(part):
                out.segments.append((i, j, 2, _number_features(text, bounds[i], bounds[j], 2)))
            if 6 < digits < 16 and PHONE_SHAPE.fullmatch(part):
                out.segments.append((i, j, 3, _number_features(text, bounds[i], bounds[j], 3)))
    for mail in LOOSE_MAIL.finditer(text, lo, hi) if AT_SIGN.search(text, lo, hi) else ():
        i, j = place.get(mail.start()), place.get(mail.end())
        if i is not None and j is not None and j - i <= MAX_TOKENS and not any(blocked[i:j]):
            out.segments.append((i, j, 0, _mail_features(text, mail.start(), mail.end(), mail)))
    return out


@dataclass(frozen=True)
class Model:
    """Weights of features, and of the kinds of two neighbouring segments (the last one: a token outside)."""

    weights: dict[str, float]
    turns: np.ndarray

    def decode(self, own: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation: ``(start, kind, end)`` of its entities. Of equal ones that with fewer entities."""
        if not own.segments:
            return []
        n = len(own.bounds) - 1
        ending: list[list] = [[] for _ in range(n + 1)]
        for i, j, kind, features in own.segments:
            ending[j].append((i, kind, sum(self.weights.get(f, 0.0) for f in features)))
        turns = self.turns.tolist()
        kinds = range(OUTSIDE + 1)
        best = [[-np.inf] * (OUTSIDE + 1) for _ in range(n + 1)]
        best[0][OUTSIDE] = 0.0
        back: list[list] = [[None] * (OUTSIDE + 1) for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i, kind, score in [(j - 1, OUTSIDE, 0.0), *ending[j]]:
                before = best[i]
                top, last = max((before[k] + turns[k][kind], k) for k in kinds)
                if top + score > best[j][kind]:
                    best[j][kind], back[j][kind] = top + score, (i, last)
        kind = max(kinds, key=lambda k: (best[n][k], k))
        j, out = n, []
        while j:
            i, last = back[j][kind]
            if kind != OUTSIDE:
                out.append((own.bounds[i], kind, own.bounds[j]))
            j, kind = i, last
        return out[::-1]


class Likelihood:
    """Log likelihood of marked lattices and its gradient, for all of them at once."""

    def __init__(self, marked: list[tuple[Lattice, set[tuple[int, int, int]]]], names: dict[str, int]) -> None:
        self.names, width = names, len(names)
        rows = []
        for number, (own, true) in enumerate(marked):
            n = len(own.bounds) - 1
            rows += [(number, j - 1, j, OUTSIDE, (), False) for j in range(1, n + 1)]
            rows += [(number, i, j, kind, [names[f] for f in features if f in names], (i, j, kind) in true) for i, j, kind, features in own.segments]
        rows.sort(key=lambda r: (r[2], r[0], r[3]))
        self.island = np.array([r[0] for r in rows], np.int64)
        self.start, self.end, self.kind = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        most = max((len(r[4]) for r in rows), default=0)
        self.features = np.full((len(rows), max(most, 1)), width)
        for k, r in enumerate(rows):
            self.features[k, : len(r[4])] = r[4]
        self.sizes = np.array([len(own.bounds) - 1 for own, _ in marked], np.int64)
        self.longest = int(self.sizes.max(initial=0))
        self.cuts = np.searchsorted(self.end, np.arange(self.longest + 2))
        by_start = np.lexsort((self.island, self.start))
        self.by_start, self.start_cuts = by_start, np.searchsorted(self.start[by_start], np.arange(self.longest + 2))
        # Rows whose numbers are added up: of the same end, island and kind, or of the same start and island.
        self.same_end = [self._heads(self.island[a:b] * (OUTSIDE + 1) + self.kind[a:b]) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        self.same_start = [self._heads(self.island[by_start[a:b]]) for a, b in zip(self.start_cuts, self.start_cuts[1:], strict=False)]
        # What the marked segmentations use.
        self.true_features = np.bincount(self.features[[r[5] for r in rows]].ravel(), minlength=width + 1).astype(float)
        self.true_turns = np.zeros((OUTSIDE + 1, OUTSIDE + 1))
        for own, true in marked:
            last, at, ends = OUTSIDE, 0, {i: (j, kind) for i, j, kind in true}
            while at < len(own.bounds) - 1:
                at, kind = ends.get(at, (at + 1, OUTSIDE))
                self.true_turns[last, kind] += 1
                last = kind

    @staticmethod
    def _heads(keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.diff(keys, prepend=-1))

    def __call__(self, weights: np.ndarray, turns: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """``(log likelihood, gradient of the weights, gradient of the turns)``."""
        score = np.append(weights, 0.0)[self.features].sum(axis=1)
        many, labels = len(self.sizes), OUTSIDE + 1
        ahead = np.full((many, self.longest + 1, labels), -np.inf)
        ahead[:, 0, OUTSIDE] = 0.0
        for j in range(1, self.longest + 1):
            own = slice(self.cuts[j], self.cuts[j + 1])
            island, kind = self.island[own], self.kind[own]
            into = np.logaddexp.reduce(ahead[island, self.start[own]] + turns[:, kind].T, axis=1) + score[own]
            heads = self.same_end[j]
            ahead[island[heads], j, kind[heads]] = np.logaddexp.reduceat(into, heads)
        total = np.logaddexp.reduce(ahead[np.arange(many), self.sizes], axis=1)
        behind = np.full((many, self.longest + 1, labels), -np.inf)
        behind[np.arange(many), self.sizes] = 0.0
        turn_sum, seen = np.zeros((labels, labels)), np.zeros(len(weights) + 1)
        for i in reversed(range(self.longest)):
            own = self.by_start[self.start_cuts[i] : self.start_cuts[i + 1]]
            island, kind = self.island[own], self.kind[own]
            rest = score[own] + behind[island, self.end[own], kind]
            both = turns[:, kind].T + rest[:, None]
            flow = np.exp(ahead[island, i] + both - total[island, None])
            for k in range(labels):
                turn_sum[:, k] += flow[kind == k].sum(axis=0)
            here = self.features[own]
            seen += np.bincount(here.ravel(), np.repeat(flow.sum(axis=1), here.shape[1]), len(seen))
            heads = self.same_start[i]
            behind[island[heads], i] = np.logaddexp.reduceat(both, heads, axis=0)
        value = float((np.append(weights, 0.0) * self.true_features).sum() + (turns * self.true_turns).sum() - total.sum())
        return value, (self.true_features - seen)[:-1], self.true_turns - turn_sum


def train(marked: list[tuple[Lattice, set[tuple[int, int, int]]]], rounds: int = ROUNDS, decay: float = 0.5) -> Model:
    """Fit by gradient steps with a rate of its own for each weight; ``decay`` pulls weights to zero."""
    names: dict[str, int] = {}
    for own, _ in marked:
        for *_, features in own.segments:
            for f in features:
                names.setdefault(f, len(names))
    slope = Likelihood(marked, names)
    weights, turns = np.zeros(len(names)), np.zeros((OUTSIDE + 1, OUTSIDE + 1))
    fall = [np.full_like(weights, 1e-6), np.full_like(turns, 1e-6)]
    for _ in range(rounds if marked else 0):
        _, up, across = slope(weights, turns)
        for now, gradient, past in ((weights, up - decay * weights, fall[0]), (turns, across - decay * turns, fall[1])):
            past += gradient**2
            now += 0.5 * gradient / np.sqrt(past)
    return Model({f: float(weights[k]) for f, k in names.items()}, turns)


class Generator:
    """Marked pieces of text: entities of every kind and things that look like them, among given words."""

    def __init__(self, words: list[str], seed: int = 11) -> None:
        self.pick = random.Random(seed)
        self.words = words or ["of", "the", "and", "in"]

    def digits(self, n: int, first: str = "") -> str:
        return first + "".join(self.pick.choice("0123456789") for _ in range(n - len(first)))

    def grouped(self, digits: str, sizes: tuple[int, ...], separator: str) -> str:
        cuts = [sum(sizes[:k]) for k in range(len(sizes))]
        return separator.join(digits[a : a + s] for a, s in zip(cuts, sizes, strict=True))

    def number(self, valid: bool) -> str:
        """A number in the ways of cards, with or without a valid check digit."""
        n, sizes = self.pick.choice([(16, (4, 4, 4, 4)), (16, (4, 4, 4, 4)), (15, (4, 6, 5)), (13, (13,)), (14, (4, 6, 4)), (19, (4, 4, 4, 4, 3))])
        first = self.pick.choice("3456") if self.pick.random() < 0.5 else self.pick.choice("0123456789")
        while luhn(digits := self.digits(n, first)) != valid:
            pass
        return self.grouped(digits, sizes, self.pick.choice(["", "", " ", "-"]))

    def phone(self) -> str:
        area, mid, end = self.digits(3), self.digits(3), self.digits(4)
        separator = self.pick.choice(" -.")
        national = self.pick.choice([f"({area}) {mid}-{end}", f"{area}{separator}{mid}{separator}{end}", f"({area}) {mid} {end}", f"({area}) {mid}-{end}"])
        code = "+" + self.pick.choice(["1", "44", "49", "33", "34", "351"])
        other = f"{code} {self.digits(2)} {self.digits(4)} {self.digits(4)}"
        return self.pick.choice([f"{code} {national}", f"{code} {national}", f"{code}{separator}{national}", national, other, code + self.digits(10)])

    def entity(self) -> tuple[int, str]:
        kind = self.pick.randrange(len(KINDS))
        if kind == 0:
            name, host = self.pick.choice(self.words).lower(), self.pick.choice(["mail", "example", "post"]) + self.digits(1)
            name = re.sub("[^a-z]", "", name) or "info"
            return kind, self.pick.choice([f"{name} @ {host}.com", f"{name} (at) {host}.org", f"{name}[at]{host}[dot]net", f"{name} [at] {host} [dot] com", f"{name}.{name}@ {host}.co.uk"])
        if kind == 1:
            return kind, ".".join(str(self.pick.randrange(1, 256)) for _ in range(4))
        return kind, self.number(True) if kind == 2 else self.phone()

    def other(self) -> str:
        """Something that is no entity."""
        pick = self.pick
        return pick.choice(
            [
                lambda: self.number(False),
                lambda: self.number(False),
                lambda: f"{pick.randrange(1900, 2100)}-{pick.randrange(1, 13):02d}-{pick.randrange(1, 29):02d}",
                lambda: f"{pick.randrange(1900, 2100)}-{pick.randrange(1900, 2100)}",
                lambda: f"{pick.randrange(1, 29):02d}.{pick.randrange(1, 13):02d}.{pick.randrange(1900, 2100)} {pick.randrange(24):02d}",
                lambda: ".".join(str(pick.randrange(1, 30)) for _ in range(pick.choice([3, 5, 6]))),
                lambda: self.digits(pick.randrange(7, 12)),
                lambda: self.digits(pick.randrange(20, 30)),
                lambda: " ".join(str(pick.randrange(1, 400)) for _ in range(pick.randrange(3, 8))),
                lambda: self.grouped(self.digits(10), (1, 3, 5, 1), "-"),
                lambda: self.grouped(self.digits(9), (3, 3, 3), pick.choice(".,")),
                lambda: f"{pick.choice(self.words)} @ {pick.randrange(1, 99)}.{pick.randrange(10, 99)}",
                lambda: f"{pick.choice(['order', 'invoice', 'version', 'ref'])} {self.digits(pick.randrange(7, 14))}",
            ]
        )()

    def piece(self) -> tuple[str, list[tuple[int, int, int]]]:
        """A text with its marked entities."""
        parts, marks, size = [], [], 0

        def put(text: str, kind: int | None = None) -> None:
            nonlocal size
            if kind is not None:
                marks.append((size, kind, size + len(text)))
            parts.append(text)
            size += len(text)

        for _ in range(self.pick.randrange(1, 4)):
            put(" ".join(self.pick.choice(self.words) for _ in range(self.pick.randrange(1, 6))) + self.pick.choice([" ", " ", " ", ": ", ", "]))
            for _ in range(self.pick.choice([1, 1, 1, 2, 2, 3])):
                if self.pick.random() < 0.6:
                    kind, text = self.entity()
                    if self.pick.random() < 0.25:
                        put(self.pick.choice(CUES[KINDS[kind]].split()) + self.pick.choice([" ", ": "]))
                    put(text, kind)
                else:
                    put(self.other())
                put(self.pick.choice([" ", " ", " ", ", ", ". ", "!! ", "% ", "\n"]))
        return "".join(parts), marks

    def marked(self, n: int) -> list[tuple[Lattice, set[tuple[int, int, int]]]]:
        """Lattices of islands with candidates, and which of these are true."""
        out = []
        while len(out) < n:
            text, marks = self.piece()
            for lo, hi in islands(text):
                own = lattice(text, lo, hi, [])
                place = {b: k for k, b in enumerate(own.bounds)}
                true = {(place[a], place[b], kind) for a, kind, b in marks if a in place and b in place}
                true &= {segment[:3] for segment in own.segments}
                if own.segments:
                    out.append((own, true))
        return out


def find_spans(text: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """``(base spans, all spans)``, each sorted by start and kind."""
    base = base_spans(text)
    more, k = [], 0
    taken = sorted((a, b) for a, _, b in base)
    for lo, hi in islands(text):
        while k < len(taken) and taken[k][1] <= lo:
            k += 1
        last = k
        while last < len(taken) and taken[last][0] < hi:
            last += 1
        more += model.decode(lattice(text, lo, hi, taken[k:last]))
    return base, sorted({*base, *more})


def sample_words(docs: DataFrame, rows: int, chars: int, id_col: str, text_col: str) -> list[str]:
    """Words of stretches of at most ``chars`` characters from up to ``rows`` documents that come first by a hash of id and text.

    Of all documents only some ``8 rows`` with the lowest hashes are looked at, so that few rows leave a task however
    many tasks there are; copies of a document count once.
    """
    h = F.xxhash64(F.col(id_col), F.col(text_col))
    share = min(1.0, 8 * rows / max(docs.count(), 1))
    start = F.pmod(h, F.greatest(F.char_length(text_col) - chars, F.lit(1))) + 1
    low = docs.where(F.col(text_col).isNotNull() & (h <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1025)))))
    own = low.select(h.alias("h"), F.substring(text_col, start, F.lit(chars)).alias("part")).groupBy("h").agg(F.min("part").alias("part"))
    parts = [r.part for r in own.orderBy("h", "part").limit(rows).collect()]
    return [w for part in parts for w in WORD.findall(part)]


def learn(words: list[str], n: int = TRAINING_ISLANDS, seed: int = 11) -> Model:
    """The model learnt from ``n`` generated islands among ``words``."""
    return train(Generator(words, seed).marked(n))


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    training_islands: int = TRAINING_ISLANDS,
) -> DataFrame:
    """``(id, base, spans)``, a row per row of ``docs``: spans of the patterns, and these with those the model adds.

    A span has ``kind``, ``start`` and ``end`` (code points, end exclusive); spans are sorted by start and then by kind as in
    ``KINDS``, overlaps between kinds included. The
    model's spans touch no base span. It is trained on the driver from ``training_islands`` generated islands, whose
    surrounding words are those of at most ``sample_rows`` stretches of ``sample_chars`` characters; without any document it
    learns from fixed words. It goes to the tasks with their code, a few hundred numbers. A NULL or empty text has no spans; rows with a NULL or repeated id are looked
    at like others; other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    model = learn(sample_words(rows, sample_rows, sample_chars, "id", "text"), training_islands)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = [id_col, "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t.as_py() or "", model) for t in batch.column(1)]
            columns = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in both[side]] for both in found], kind) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    own = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {own}, base {SPANS}, spans {SPANS}")
