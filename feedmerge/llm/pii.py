"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Kinds and their validators:

* ``email``, ``ip`` (parts of at most 255), ``card`` (12 to 19 digits, Luhn) and
  ``phone`` (9 to 15 digits) are the base kinds. Matches are leftmost and do not
  overlap within a kind; a match its validator rejects is dropped and not retried.
* ``iban`` (mod 97) and ``account`` (8 to 12 digits next to a word that announces
  an account, identity or social security number) are added by the method. They never remove a base
  span.

Each span has a score: what its pattern and checksum are worth, raised when words
near it announce its kind and lowered when they speak against it. The score ranks
spans; base spans are reported whatever it is, ``account`` only from ``MIN_SCORE``.

Null and empty texts have no spans. Positions count code points, end exclusive.
Rows with equal ids are searched one by one, and all other columns pass through.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .common import with_columns

KINDS = ["email", "ip", "card", "phone", "iban", "account"]
MIN_SCORE = 0.5
WINDOW = 40

#: Score of a confirmed span before its context is looked at.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "account": 0.2}
#: Words that announce a kind, lower case, in the languages of the corpus.
ANNOUNCE = {
    "email": "email mail e-mail contact write correo courriel",
    "ip": "ip address server host login",
    "card": "card visa credit debit payment tarjeta carte karte",
    "phone": "phone tel telephone call mobile fax telefon",
    "iban": "iban bank account konto cuenta compte",
    "account": "ssn account passport konto cuenta compte dni",
}
AGAINST = {
    "ip": "version release chapter section",
    "card": "order invoice isbn serial",
    "phone": "order invoice isbn serial",
    "account": "order invoice isbn serial version",
}

AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?<![\w.+-])[0-9]{3}-?[0-9]{2,4}-?[0-9]{3,5}(?![\w.-])")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
ANNOUNCE_SETS = {k: frozenset(v.split()) for k, v in ANNOUNCE.items()}
AGAINST_SETS = {k: frozenset(v.split()) for k, v in AGAINST.items()}


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


def emails(text: str):
    """Spans of the email rule, found from their @ so that long words cost one pass."""
    end, at = 0, text.find("@")
    while at >= 0:
        found = AT.match(text, at)
        start = at
        if found:
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                end = found.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    for m in IP.finditer(text):
        if all(int(part) <= 255 if len(part) < 10 else int(part.lstrip("0")[:10] or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = "".join(DIGITS.findall(m[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= len(DIGITS.findall(m[0])) <= 15:
            yield m.span()


def ibans(text: str):
    """Spans of the IBAN rule; of a run of groups the longest part that passes, so words after it do no harm."""
    at = 0
    while m := IBAN.search(text, at):
        at = m.start() + 2
        compact = m[0].replace(" ", "")
        ends = [m.end()] + [m.start() + i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] == " "]
        for end in ends:
            n = len(text[m.start() : end].replace(" ", ""))
            if n < 15:
                break
            if mod97(compact[:n]):
                yield m.start(), end
                at = end
                break


def accounts(text: str):
    for m in ACCOUNT.finditer(text):
        if 8 <= len(DIGITS.findall(m[0])) <= 12:
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "account": accounts}


def score(kind: str, text: str, start: int, end: int) -> float:
    """The prior of the kind, moved by the words within ``WINDOW`` characters."""
    near = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    words = {w.lower() for w in WORD.findall(near)}
    value = PRIOR[kind]
    if words & ANNOUNCE_SETS[kind]:
        value += 0.4 * (1 - value) + 0.2
    if words & AGAINST_SETS.get(kind, frozenset()):
        value -= 0.3
    return round(min(1.0, max(0.0, value)), 4)


def find(text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of every span, by start and then by kind as listed."""
    if not text:
        return []
    kinds = [k for k, seen in (("email", "@" in text),) if seen]
    if DIGITS.search(text):
        kinds += KINDS[1:]
    spans = []
    for kind in kinds:
        for start, end in FINDERS[kind](text):
            value = score(kind, text, start, end)
            if kind != "account" or value >= MIN_SCORE:
                spans.append((start, KINDS.index(kind), end, kind, value))
    return [(s, e, k, v) for s, _, e, k, v in sorted(spans)]


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: an array of spans (kind, start, end, score)."""

    def make():
        def work(batch):
            return {
                "pii": [
                    [{"kind": k, "start": s, "end": e, "score": v} for s, e, k, v in find(t)]
                    for t in batch.column(text).to_pylist()
                ]
            }

        return work

    return with_columns(docs, "pii array<struct<kind:string,start:bigint,end:bigint,score:double>>", make, text)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, derived in the engine from the spans of ``find_pii``."""
    from pyspark.sql import functions as F

    of = lambda *kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    found = find_pii(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(joined(of(*KINDS[:4])), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
