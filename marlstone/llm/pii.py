"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) follow fixed patterns and always stay.
Further kinds are kept only if their score reaches ``THRESHOLD``: an IBAN that
passes mod 97 (up to the end of any of its tokens), a phone or identity number
without a plus sign that has a telling word nearby, a key of a well-known
format, and a secret with a telling word nearby: a run of letters and digits as
varied as a random one, or a less varied value that a telling name is given.  The
scan is linear in the text, also on long runs of matching characters.

Defined results: a null or empty text has no spans.  Repeated rows are
scanned one by one.  An empty table gives no rows.  Extra columns are ignored
by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_phone", "ssn", "access_key", "secret")

_LOCAL = r"[A-Za-z0-9._%+-]"
# possessive and only from where a run begins: a run that fails is not tried again from its middle
_EMAIL = rf"{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_AT_RUN = {"email": (re.compile(_EMAIL), re.compile(rf"(?<!{_LOCAL}){_EMAIL}")), "ip": (re.compile(_IP), re.compile(rf"(?<![0-9]){_IP}"))}
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_LEAST = 15
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /-])[0-9]{2,5}(?:[ -]?[0-9]{2,5}){1,3}(?![0-9.])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,256}+(?![A-Za-z0-9+/_-])")
#: Fixed formats of keys: cloud access, repository, chat, search and payment keys, web tokens, private keys.
_KEYS = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}"
    r"|[rs]k_live_[A-Za-z0-9]{16,}+|eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]++)(?![A-Za-z0-9])"
    r"|-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[^-]*+(?:-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?"
)
#: A value after a name such as ``password``; the name is looked for before the match.
_VALUE = re.compile(r"[=:][ \t]{0,3}[\"']?([^\s\"',;<>()&=:]{8,}+(?:={1,2}(?![=A-Za-z0-9]))?)")
_NAME = re.compile(r"(?:passw(?:or)?d|passwd|pwd|secret|token|credentials?|(?:api|access|private|auth|secret)[ _-]?key)[\"']?[ \t]{0,3}$", re.I)
NAME_CHARS, NAMED_BITS = 24, 2.0  # a chosen password is less varied than a random run
SECRET_BITS = 3.0  # entropy of a secret's characters; words and counters have less, or no digits

#: Score of a proposed span before and after its checksum, and what words near it add.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.7, "iban": 0.3, "national_phone": 0.35, "ssn": 0.4, "access_key": 0.7, "secret": 0.2}
CONFIRMED = {"card": 0.4, "iban": 0.6, "secret": 0.2}
CONTEXT_BONUS, CONTEXT_CHARS, THRESHOLD = 0.3, 40, 0.6
CONTEXT = {
    "email": re.compile(r"e-?mail|contact", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|credit|carte|karte|tarjeta", re.I),
    "phone": re.compile(r"phone|call|\btel|mobile|téléphone|telefon|teléfono", re.I),
    "iban": re.compile(r"iban|account|konto|compte|cuenta", re.I),
    "national_phone": re.compile(r"phone|call\b|\btel\b|\btel\.|mobile|téléphone|telefon|teléfono", re.I),
    "ssn": re.compile(r"\bssn\b|social security", re.I),
    "access_key": re.compile(r"key|token|secret|aws", re.I),
    "secret": re.compile(r"token|secret|passw|credential|\bpwd\b|(?:api|access|private|auth)[ _-]?key", re.I),
}

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def random_like(run: str, bits: float = SECRET_BITS) -> bool:
    """Letters and digits, and an entropy of ``bits`` a character or more."""
    if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return False
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values()) >= bits


def _from_runs(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap of a pattern whose match begins at a run's start, or where the match before ended."""
    here, anywhere = _AT_RUN[kind]
    at = 0
    while m := (at and here.match(text, at)) or anywhere.search(text, at):
        yield m.span()
        at = m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest span of whole tokens that passes mod 97 from each start; where none does, the next token is tried."""
    at = 0
    while m := _IBAN.search(text, at):
        a, b = m.span()
        while b and not mod97(text[a:b].replace(" ", "")):
            b = text.rfind(" ", a, b)
            b = b if b > 0 and len(text[a:b].replace(" ", "")) >= IBAN_LEAST else 0
        if b:
            yield a, b
        at = b or a + 1


def _secrets(text: str) -> Iterator[tuple[str, int, int]]:
    """Keys of known formats, values of telling names, and runs that look random; of overlapping ones the first named stays."""
    taken = [("access_key", *m.span()) for m in _KEYS.finditer(text)]
    more = []
    for m in _VALUE.finditer(text):
        value = m[1].rstrip(".!?")
        if len(value) >= 8 and random_like(value, NAMED_BITS) and _NAME.search(text, max(0, m.start() - NAME_CHARS), m.start()):
            more.append((m.start(1), m.start(1) + len(value)))
    more += [m.span() for m in _SECRET.finditer(text) if random_like(m[0])]
    ends: list[tuple[int, int]] = sorted((a, b) for _, a, b in taken)
    yield from taken
    for a, b in more:
        i = bisect_left(ends, (b, 0))  # spans before i begin before b; they don't overlap, so only the last can reach a
        if not i or ends[i - 1][1] <= a:
            insort(ends, (a, b))
            yield "secret", a, b


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def propose(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a checksum) of all spans that pass their validator."""
    if "@" in text:
        for a, b in _from_runs("email", text):
            yield "email", a, b, False
    for a, b in _from_runs("ip", text):
        if all(map(_small, text[a:b].split("."))):
            yield "ip", a, b, False
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 40 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), False
    for a, b in _ibans(text):
        yield "iban", a, b, True
    for kind, a, b in _secrets(text):
        yield kind, a, b, True
    for kind, pat in (("national_phone", _NATIONAL), ("ssn", _SSN)):
        for m in pat.finditer(text):
            yield kind, *m.span(), False


def spans(text: str) -> list[Span]:
    """All spans by kind as listed, then start.  A span of a further kind that overlaps a base span is dropped."""
    if not text:
        return []
    out, base = [], []
    for kind, a, b, sure in propose(text):
        near = text[max(0, a - CONTEXT_CHARS) : a] + " " + text[b : b + CONTEXT_CHARS]
        score = PRIOR[kind] + (CONFIRMED.get(kind, 0) if sure else 0) + (CONTEXT_BONUS if CONTEXT[kind].search(near) else 0)
        if kind in BASE_KINDS:
            base.append((a, b))
        elif score < THRESHOLD or any(a < y and x < b for x, y in base):
            continue
        out.append((kind, a, b, min(1.0, round(score, 2))))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, score; code points, end exclusive) of every row."""

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in common.text_slices(batches):
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans(t or "")] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return common.pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, f"doc_id long, spans {SPANS}")


def masked(text: str) -> str:
    """The text with ``<KIND>`` in place of every span; of overlapping spans the outermost first one names it."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"<{kind.upper()}>")
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data masked in ``text``; every other column as it is."""
    out = [f.name for f in docs.schema.fields]
    i = out.index(text)

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in common.text_slices(batches, text):
            new = pa.array([None if t is None else masked(t) for t in part.column(i).to_pylist()], part.schema.field(i).type)
            yield pa.RecordBatch.from_arrays([new if k == i else part.column(k) for k in range(len(out))], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find``'s spans: the base kinds, then the further ones and all together."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    line = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"), *[count(k) for k in KINDS[len(BASE_KINDS) :]], F.size("spans").cast("long").alias("n_spans"))
