"""Personal data by weak supervision.

Candidate spans come from loose patterns. Six labelers vote for, against or
abstain on each: the exact rule, the usual shape, a gazetteer, words nearby,
the characters around, and a checksum or range. Candidates are counted by vote
pattern over the whole corpus; expectation-maximisation estimates every
labeler's reliability and each pattern's probability from the counts, and a
logistic span classifier is trained on those probabilities with more features
than the votes. Spans of the exact rules always stay; the classifier adds the
candidates it is sure of.

Not looked for: spelt addresses without brackets or with blanks around a bare
dot; IPv6 addresses without any decimal digit, and short ones such as 10::2 or
::1; local numbers other than three-three-four digits (a 1 before or not) and,
from a trunk 0, nine to eleven digits in groups of one separator.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_slices

# fixed values: kinds in their fixed order
KINDS = ["email", "ip", "card", "phone"]

DIGIT_OR_AT = re.compile(r"[0-9@]").search
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# candidates that no exact rule covers
SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?"
                   r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I)
COLONS = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
SHORT_COLONS = re.compile(r"(?<![0-9A-Za-z:._-])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::"
                          r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![0-9A-Za-z:])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])(?:1[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
TRUNK_PHONE = re.compile(r"(?<![0-9+.(-])(?<![0-9][ ./-])\(?0[0-9]{1,4}\)?([ ./-])[0-9]{2,8}(?:\1[0-9]{2,4}){0,4}"
                         r"(?![0-9]|[ ./-][0-9])")
AT_SPELT = re.compile(r"at[\])]", re.I).search
# area code and exchange begin with neither 0 nor 1; after a trunk 0 comes no other
NATIONAL = re.compile(r"1?[2-9][0-9]{2}[2-9][0-9]{6}|0[1-9][0-9]{7,9}")

# fixed values: gazetteer and context words
TOP_LEVELS = frozenset("com org net edu gov mil int info biz io co de fr es uk us eu it nl ch at be ca au jp cn ru br".split())
DIALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98".split())
CARD_LENGTHS = {"3": (14, 15, 16), "4": (13, 16, 19), "5": (16,), "6": (16, 17, 18, 19), "2": (16,)}
NEAR = {"email": re.compile(r"e-?mail|contact|write|correo|adresse", re.I),
        "ip": re.compile(r"\bip\b|address|host|server|direcci", re.I),
        "card": re.compile(r"card|visa|master|amex|tarjeta|carte|karte|payment", re.I),
        "phone": re.compile(r"phone|tel|call|fax|mobile|m[oó]vil|handy", re.I)}
AGAINST = re.compile(r"version|license|isbn|token|order|section|page|invoice|\bid\b|#", re.I)
CONTEXT = 32  # characters looked at on either side

VOTES = 6


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small(parts: list[str]) -> bool:
    """Numbers of at most 255, whatever zeros lead them."""
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def short_address(text: str) -> bool:
    """An IPv6 address with ``::`` that hardly is anything else: a decimal digit, three groups or four digits first."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    groups = [g for g in text.split(":") if g]
    return any("0" <= c <= "9" for c in text) and (len(groups) > 2 or len(text.split(":")[0]) == 4)


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in AT_DOMAIN.finditer(text):
        start = at = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def exact_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind, valid) of the four exact patterns; those that fail their check are not valid."""
    out = []
    if "@" in text:
        out += [(a, b, 0, True) for a, b in emails(text)]
    for m in DOTTED.finditer(text):
        out.append((m.start(), m.end(), 1, small(m.group().split("."))))
    for m in DIGITS.finditer(text):
        digits = digits_of(m.group())
        if len(digits) >= 13:
            out.append((m.start(), m.end(), 2, 14 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in PLUS.finditer(text):
            out.append((m.start(), m.end(), 3, 10 <= len(digits_of(m.group())) <= 15))
    return out


def candidates(text: str) -> list[tuple[int, int, int, bool, str]]:
    """(start, end, kind, exact, pattern) in order; ``pattern`` is votes and features as text."""
    digits = DIGIT_OR_AT(text)
    found = exact_spans(text) if digits else []
    taken = [(a, b) for a, b, _, valid in found if valid]
    loose = []
    if AT_SPELT(text):
        loose += [(m.start(), m.end(), 0) for m in SPELT.finditer(text)]
    if digits:
        if ":" in text:
            loose += [(m.start(), m.end(), 1) for m in COLONS.finditer(text)]
        if "::" in text:
            loose += [(m.start(), m.end(), 1) for m in SHORT_COLONS.finditer(text) if short_address(m.group())]
        loose += [(m.start(), m.end(), 3) for m in LOCAL_PHONE.finditer(text)]
        loose += [(m.start(), m.end(), 3) for m in TRUNK_PHONE.finditer(text)
                  if 9 <= len(digits_of(m.group())) <= 11 and not LOCAL_PHONE.match(text, m.start())]
    rules = [(a, b, k, "+" if valid else "-") for a, b, k, valid in found]
    # the exact rules do not speak of what their patterns cannot match
    rules += [(a, b, k, "0") for a, b, k in loose if not any(x < b and a < y for x, y in taken)]
    return [(a, b, k, rule == "+", described(text, a, b, k, rule)) for a, b, k, rule in sorted(rules)]


def described(text: str, a: int, b: int, kind: int, rule: str) -> str:
    """The six votes (+ for, - against, 0 abstain; ``rule`` is the first) and coarse features of a candidate."""
    span, digits = text[a:b], digits_of(text[a:b][:64])
    before, after = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    left, right = before[-1:], after[:1]
    shape = gazetteer = check = "0"
    if kind == 0:
        if "@" in span:
            shape = "+" if 0 < span.find("@") <= 64 and len(span) <= 254 else "0"
        else:
            last = re.split(r"[. )\]]+", span)[-1]
            shape, check = ("+", "0") if last.isalpha() and len(last) > 1 else ("-", "-")
        gazetteer = "+" if re.split(r"[. )\]]+", span.lower())[-1] in TOP_LEVELS else "-"
    elif kind == 1:
        parts = span.split(".")
        shape = "+" if len(parts) == 4 and all(p == "0" or not p.startswith("0") for p in parts) or ":" in span else "-"
        gazetteer = "-" if parts[0] in ("0", "127", "255") else "0"
        check = "+" if ":" in span or small(parts) else "-"
    elif kind == 2:
        shape = "+" if span.isdigit() or re.fullmatch(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", span) else "0"
        gazetteer = "+" if len(digits) in CARD_LENGTHS.get(digits[0], ()) else "-"
        check = "+" if luhn(digits) and len(digits) >= 13 else "-"
    else:
        shape = "+" if re.fullmatch(r"(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?([ .-]?[0-9]{2,4}){2,4}", span) else "0"
        gazetteer = ("+" if digits.startswith(DIALLING) else "-") if span.startswith("+") else "0"
        if span.startswith("+"):
            check = "+" if 10 <= len(digits) <= 15 else "-"
        else:
            check = "+" if NATIONAL.fullmatch(digits) else "0"
    near = "+" if NEAR[KINDS[kind]].search(before) else "-" if AGAINST.search(before) else "0"
    around = "-" if left.isalnum() or right.isalnum() else "+"
    style = "p" if span.isdigit() else "s" if " " in span else "d" if "." in span else "o"
    edge = "".join("b" if not c or c.isspace() else "a" if c.isalnum() else "m" for c in (left, right))
    return f"{rule}{shape}{gazetteer}{near}{around}{check}{style}{edge}{min(len(digits), 20) // 4}"


class Model:
    """Span classifier: weights of the features of each kind; the labelers' estimated reliabilities."""

    def __init__(self, weights: dict, reliability: dict | None = None):
        self.weights, self.reliability, self.known = weights, reliability, {}

    def probability(self, kind: int, pattern: str) -> float:
        key = kind, pattern
        if key not in self.known:
            w = self.weights.get(kind, {})
            z = w.get("bias", -9.0) + sum(w.get((i, c), 0.0) for i, c in enumerate(pattern))
            self.known[key] = float(1 / (1 + np.exp(-z)))
        return self.known[key]


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns (0 against, 1 abstain, 2 for): probability of each pattern, and
    P(vote | class) of each labeler. The start is the votes' own majority. An abstention tells
    nothing of the class: a candidate is judged by those labelers that voted."""
    q = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(axis=1)))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - q), counts * q])  # class x pattern
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        says = np.stack([weight @ (votes == v) + 0.5 for v in range(3)], axis=2)  # class x labeler x vote
        voted = np.log(says / (says[:, :, :1] + says[:, :, 2:]))
        voted[:, :, 1] = 0
        says /= says.sum(axis=2, keepdims=True)
        joint = np.log(prior)[:, None] + voted[:, np.arange(votes.shape[1]), votes].sum(axis=2)
        q = 1 / (1 + np.exp(np.clip(joint[0] - joint[1], -50, 50)))
    return q, says


def balanced(patterns: list[str], counts: np.ndarray) -> np.ndarray:
    """Counts, those of candidates that the exact rule abstains on raised to weigh as much as the others
    together: the classifier decides on them alone, and the others may outnumber them by any factor."""
    free = np.array([p[0] == "0" for p in patterns])
    if not free.any() or free.all():
        return counts
    return np.where(free, counts * max(1.0, counts[~free].sum() / counts[free].sum()), counts)


def classifier(patterns: list[str], q: np.ndarray, counts: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> dict:
    """Logistic regression (Newton steps) on one-hot features, weighted by count, towards ``q``."""
    names = ["bias", *sorted({(i, c) for p in patterns for i, c in enumerate(p)})]
    index = {n: i for i, n in enumerate(names)}
    x = np.zeros((len(patterns), len(names)))
    x[:, 0] = 1
    for r, p in enumerate(patterns):
        for i, c in enumerate(p):
            x[r, index[i, c]] = 1
    w = np.zeros(len(names))
    for _ in range(rounds):
        y = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (counts * y * (1 - y) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(names))
        w += np.linalg.solve(hessian, x.T @ (counts * (q - y)) - ridge * w)
    return dict(zip(names, w.tolist()))


CANDIDATES_DDL = ("doc_id long, found array<struct<start:int,end:int,kind:int,exact:boolean,pattern:string>>")
FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("exact", pa.bool_()),
                            ("pattern", pa.string())]))


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in FOUND.value_type]
    for part in text_slices(batches):
        found = [[dict(zip(names, c)) for c in candidates(t)] if t else [] for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, FOUND)], names=["doc_id", "found"])


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's candidates, written as a table: both training and results start from it."""
    return staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                  .mapInArrow(find, CANDIDATES_DDL), "pii-candidates")


def fit(found: DataFrame) -> Model:
    """Reliabilities and classifier from all candidates. Only the counts of vote patterns reach
    the driver: at most 3**6 votes x 4 styles x 9 edges x 6 lengths for a kind, in practice some hundreds."""
    rows = (found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern").count().collect())
    reliability, weights = {}, {}
    for kind in range(len(KINDS)):
        own = sorted((r["pattern"], r["count"]) for r in rows if r["kind"] == kind)
        if own:
            patterns, counts = [p for p, _ in own], np.array([n for _, n in own], float)
            votes = np.array([["-0+".index(c) for c in p[:VOTES]] for p in patterns])
            q, reliability[kind] = estimate(votes, counts)
            weights[kind] = classifier(patterns, q, balanced(patterns, counts))
    return Model(weights, reliability)


def decide(found: list[dict], model: Model, least: float) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, exact) of the spans that count, in order: the exact ones, and those
    the classifier is sure of that overlap none and failed no check."""
    spans = [(c["start"], c["kind"], c["end"], True) for c in found if c["exact"]]
    taken = [(a, b) for a, _, b, _ in spans]
    for c in found:
        if (not c["exact"] and c["pattern"][5] != "-" and model.probability(c["kind"], c["pattern"]) >= least
                and not any(a < c["end"] and c["start"] < b for a, b in taken)):
            spans.append((c["start"], c["kind"], c["end"], False))
            taken.append((c["start"], c["end"]))
    return sorted(spans)


RESULT_DDL = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
              "n_added long")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """Personal data of every whole text.

    A null or empty text has none. Offsets count code points, ends exclusive.
    Repeated rows get equal answers; an empty table gives no rows; other columns
    are ignored. Runs of any length are scanned in linear time.

    Returns doc_id, n_email, n_ip, n_card, n_phone (spans of the exact rules),
    base_sha256 (of those as kind:start:end, comma-joined), spans (all spans in
    that form) and n_added (spans the classifier added).
    """
    found = find_candidates(docs, id_col, text_col)
    weights = docs.sparkSession.sparkContext.broadcast(fit(found).weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights.value)
        for batch in batches:
            rows = []
            for doc, own in zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist()):
                spans = decide(own, model, least)
                told = [f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans]
                exact = [t for t, s in zip(told, spans) if s[3]]
                n = [sum(k == kind and e for _, k, _, e in spans) for kind in range(len(KINDS))]
                rows.append((doc, *n, hashlib.sha256(",".join(exact).encode()).hexdigest(), ",".join(told),
                             len(told) - len(exact)))
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            names = [c.split()[0] for c in RESULT_DDL.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)],
                                             names=names)
    return found.mapInArrow(run, RESULT_DDL)


def mask(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.9) -> DataFrame:
    """Replace every span by its kind in angle brackets, <EMAIL> for one; other columns stay. A null text stays null."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights.value)
        names = [f.name for f in FOUND.value_type]
        for part in text_slices(batches, text_col):
            out = []
            for t in part.column(text_col).to_pylist():
                at, pieces = 0, []
                for a, kind, b, _ in decide([dict(zip(names, c)) for c in candidates(t)], own, least) if t else []:
                    if b > at:
                        pieces += [t[at:a], f"<{KINDS[kind].upper()}>"]
                        at = b
                out.append("".join([*pieces, t[at:]]) if pieces else t)
            yield part.set_column(part.schema.get_field_index(text_col), text_col, pa.array(out, pa.string()))
    return docs.mapInArrow(run, docs.schema)
