"""Personal data: patterns propose spans, checks confirm them, words nearby adjust their score.

Kinds of the base: email, ip (parts at most 255), card (14 to 19 digits, Luhn), phone (10 to 15 digits).
Their confirmed spans are always reported. Kinds that the method adds: iban (the length of its country, modulo
97), and national_id, which is reported only where the words round it lift its score to ``THRESHOLD``.

Cases: a null or empty text has no spans. Spans count code points, the end is exclusive. Spans of one kind
never overlap, spans of different kinds may; ``redact`` joins those that do. Every step takes time in
proportion to the text, also for long runs of one character. Rows with the same id are handled one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import shield

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.3}
NEAR = 40
THRESHOLD = 0.5
WORDS_FOR = {
    "email": "mail|e-mail|email|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|telefon|telephone|mobil",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "national_id": "ssn|social security|sozialversicherung|securite sociale|seguridad social",
}
#: Characters of an account number by its country, as registered; other codes may have 15 to 34.
IBAN_LENGTH = {code: int(n) for n, codes in (line.split(":") for line in (
    "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV",
    "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST",
    "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA",
    "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU")) for code in codes.split()}
WORDS_AGAINST = "version|isbn|issn|serial|sku|build|order no"

# A candidate cannot begin inside a run of the characters it begins with, so each run is tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = {n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in range(15, 35)}
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_FOR = {kind: re.compile(rf"\b(?:{words})\b", re.IGNORECASE) for kind, words in WORDS_FOR.items()}
_AGAINST = re.compile(rf"\b(?:{WORDS_AGAINST})\b", re.IGNORECASE)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an account number: first four characters last, letters as 10 to 35, remainder 1."""
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            # What lies before this sign can't be part of a later match.
            done = at + 1
        at = text.find("@", done)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each start so many characters as its country has, whatever follows them; for a country that is not
    registered the longest that ends at a border and passes."""
    done = 0
    for m in _IBAN.finditer(text):
        if m.start() < done:
            continue
        length = IBAN_LENGTH.get(m.group()[:2])
        for n in [length] if length else range(34, 14, -1):
            rest = _IBAN_REST[n].match(text, m.end())
            if rest and mod97(text[m.start() : rest.end()]):
                done = rest.end()
                yield m.start(), done
                break


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and len(d := _digits(m.group())) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                yield "phone", *m.span()
    for start, end in _ibans(text):
        yield "iban", start, end
    if "-" in text:
        for m in _NATIONAL.finditer(text):
            yield "national_id", *m.span()


def find(text: str | None) -> list[dict]:
    """The spans of one text in order of start, then kind."""
    out = []
    for kind, start, end in _proposed(text or ""):
        near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
        score = SCORE[kind] + 0.3 * bool(_FOR[kind].search(near)) - 0.3 * bool(_AGAINST.search(near))
        if kind in BASE_KINDS or score >= THRESHOLD:
            out.append({"kind": kind, "start": start, "end": end, "score": round(min(1.0, score), 2)})
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def redact(text: str | None, spans: list[dict]) -> str | None:
    """The text with each group of overlapping spans replaced by the kind of its first."""
    if not spans:
        return text
    parts, done = [], 0
    for s in spans:
        if s["start"] >= done:
            parts += [text[done : s["start"]], f"<{s['kind'].upper()}>"]
        done = max(done, s["end"])
    return "".join([*parts, text[done:]])


def mark(documents: DataFrame, replace: bool = False) -> DataFrame:
    """All columns of ``documents`` and ``pii``, the array of spans; the text is redacted if ``replace``."""
    documents, restore = shield(documents, ["text"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = part.column(at).to_pylist()
                spans = [find(t) for t in texts]
                columns = part.columns
                if replace:
                    columns[at] = pa.array([redact(t, s) for t, s in zip(texts, spans)], part.column(at).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*part.schema.names, "pii"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return restore(documents.mapInArrow(run, f"{columns}, pii array<struct<kind:string,start:bigint,end:bigint,score:double>>"), "pii")


def listed(spans: Column) -> Column:
    """Spans as one text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
