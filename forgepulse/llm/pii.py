"""Personal data: certain patterns, and candidates judged by boosted trees."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.boosting import Booster

KINDS = ("email", "ip", "card", "phone")
# Documents looked through for training spans, about.
SAMPLE_DOCS = 8000
# Spans trained on, at most.
SAMPLE_SPANS = 8000
# A candidate is added from this calibrated probability on.
THRESHOLD = 0.9
CONTEXT = 40
SEED = 42

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def _emails(text: str) -> Iterator[Span]:
    """A match is found from its only @: the local part reaches back to the match before."""
    end = 0
    for found in _AT.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            end = found.end()
            yield "email", start, end


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind and start."""
    spans = list(_emails(text)) if "@" in text else []
    for found in _IP.finditer(text):
        if _octets(found[0]):
            spans.append(("ip", *found.span()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _NO_DIGITS.sub("", found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *found.span()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGITS.sub("", found[0])) <= 15:
                spans.append(("phone", *found.span()))
    return spans


# Generators of candidates: wide nets, which may overlap each other.
_RUN = re.compile(r"[0-9]+(?:[\x20().\[\]/-]{1,3}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_MARK = re.compile(r"[\[({\x20][Aa][Tt][\])}\x20]|@")
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SPELLED_DOT = r"\x20?[\[({\x20][Dd][Oo][Tt][\])}\x20]\x20?"
_DOMAIN = re.compile(rf"\x20?{_LABEL}(?:(?:{_SPELLED_DOT}|\x20?\.\x20?){_LABEL})+")
# After a plain "at" a full stop before a space ends a sentence.
_DOMAIN_OF_WORDS = re.compile(rf"\x20?{_LABEL}(?:(?:{_SPELLED_DOT}|\.){_LABEL})+")


def _numbers(text: str) -> Iterator[Span]:
    """Every sequence of neighbouring groups of digits with as many digits as a phone or a
    card has, and every four short groups."""
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [group.span() for group in _GROUP.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            opened = start - (text[start - 1:start] in ("+", "("))
            digits = 0
            for first, end in groups[i:i + 19]:
                digits += end - first
                if digits > 19:
                    break
                if 7 <= digits <= 15:
                    yield "phone", opened, end
                if digits >= 13:
                    yield "card", opened, end
            four = groups[i:i + 4]
            if len(four) == 4 and all(end - first <= 3 for first, end in four):
                yield "ip", start, four[-1][1]


def _spelled(text: str) -> Iterator[Span]:
    """Addresses around every mark: the local part reaches back from it, the domain follows."""
    for mark in _MARK.finditer(text):
        words = mark[0][0] == mark[0][-1] == " "
        domain = (_DOMAIN_OF_WORDS if words else _DOMAIN).match(text, mark.end())
        if not domain:
            continue
        end = mark.start() - (text[mark.start() - 1:mark.start()] == " ")
        start = end
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        if start < end:
            yield "email", start, domain.end()


class Covered:
    """The places of a text that spans cover, a byte each, so that spans of any number are
    compared in time linear in the text."""

    def __init__(self, text: str, spans: list[Span]):
        self.places = bytearray(len(text))
        for span in spans:
            self.add(span)

    def add(self, span: Span) -> None:
        _, start, end = span
        self.places[start:end] = b"\x01" * (end - start)

    def meets(self, span: Span) -> bool:
        return self.places.find(1, span[1], span[2]) >= 0


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data: numbers with separators as phone, card or address,
    and e-mail addresses, also spelled out. Overlaps are allowed."""
    found = {*_numbers(text), *_spelled(text)}
    return sorted(found, key=lambda span: (KINDS.index(span[0]), *span[1:]))


# Words near a span that speak for or against a kind.
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "correo", "courriel", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "addr", "ping", "login", "client"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "carte", "karte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "mobil", "whatsapp", "sms"),
}
AGAINST = (
    "version", "isbn", "issn", "order", "invoice", "id", "no", "page", "pp", "vol", "doi", "sku",
    "date", "serial", "build", "release", "price", "usd", "eur", "section", "chapter", "model",
)
_WORD = re.compile(r"[^\W\d_][\w-]*")


def features(text: str, span: Span) -> list[float]:
    """The form of a span, and what stands around it."""
    kind, start, end = span
    inner = text[start:end]
    digits = _NO_DIGITS.sub("", inner)
    groups = [len(part) for part in re.split(r"[^0-9]+", inner) if part]
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    near = [word.lower() for word in _WORD.findall(before)[-5:] + _WORD.findall(after)[:2]]
    separators = [c for c in inner if not c.isalnum()]
    parts = [int(part) for part in re.split(r"[^0-9]+", inner) if part and len(part) <= 9]
    return [
        *(float(kind == one) for one in KINDS),
        float(len(inner)), float(len(digits)), float(len(separators)), float(len(set(separators))),
        float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[-1] if groups else 0),
        float(bool(groups) and len(set(groups)) == 1),
        float(16 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and max(parts) <= 255),
        float(inner.startswith("+")), float("(" in inner), float("[" in inner), float("@" in inner),
        float(inner.startswith("(")), float(inner.count("(") == inner.count(")")),
        float("." in inner), float("-" in inner), float("/" in inner), float(" " in inner),
        float(1900 <= (parts[0] if parts else 0) <= 2100), float(len(set(digits))),
        float(any(word in HINTS[kind] for word in near)),
        float(any(word in AGAINST for word in near)),
        float(before[-1:].isalnum()), float(before[-1:] in "$€£#v.:/"  and before != ""),
        float(after[:1].isalnum()), float(after[:1] in "%/:" and after != ""),
        float(sum(c.isalpha() for c in inner)), float(inner.lower().count("at")),
        float(inner.lower().count("dot")),
        # A number that goes on beyond the span: joined by a sign, or by a space.
        float(bool(re.search(r"[0-9][().\[\]/-]{1,3}$", before))), float(bool(re.search(r"[0-9]\x20$", before))),
        float(bool(re.match(r"[().\[\]/-]{1,3}[0-9]", after))), float(bool(re.match(r"\x20[0-9]", after))),
    ]


def _disguised(kind: str, inner: str) -> list[str]:
    """Other ways to write a certain span, which the fixed patterns miss."""
    if kind == "email":
        name, _, domain = inner.partition("@")
        return [
            f"{name} at {domain.replace('.', ' dot ')}", f"{name}[at]{domain.replace('.', '[dot]')}",
            f"{name}[at]{domain}", f"{name}(at){domain}", f"{name} (at) {domain}",
            f"{name} [at] {domain}",
        ]
    if kind == "ip":
        return [inner.replace(".", "[.]")]
    digits = _NO_DIGITS.sub("", inner)
    if kind == "card":
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours)]
    national = digits[-10:]
    return [
        f"({national[:3]}) {national[3:6]}-{national[6:]}", f"{national[:3]}-{national[3:6]}-{national[6:]}",
        f"0{national[:2]} {national[2:9]}", f"0{national[:3]}/{national[3:]}", f"0{national[:3]} {national[3:]}",
    ]


def _harmless(i: int) -> tuple[str, str]:
    """Numbers that are no personal data, with a word before them, made by rule."""
    a, b, c = i * 7919 % 97, i * 104729 % 89, i * 1299709 % 9973
    forms = (
        ("date", f"20{a % 30:02d}-{b % 12 + 1:02d}-{c % 28 + 1:02d}"),
        ("version", f"{a % 20}.{b % 30}.{c % 400}.{c}"),
        ("order", f"{10_000_000 + c * 7 + a * b}"),
        ("isbn", f"978-{a % 9}-{c:04d}-{b:04d}-{a % 9}"),
        ("serial", f"{a:03d}{b:03d}{c:05d}{a:03d}{b:02d}"),
        ("page", f"{a}-{b} {c} {a + 100}-{a + 130}"),
        ("price", f"{a},{b:03d},{c:04d}.00 {c}"),
        ("id", f"{c:05d}/{a:03d}-{b:04d}"),
        ("section", f"{a}.{b % 9}.{c % 9}.{a % 9} {b}"),
        ("look", f"it up at site{a}.example"),
        ("stands", f"now at {a}.{b}"),
    )
    return forms[i % len(forms)]


def training_rows(text: str) -> list[tuple[list[float], float]]:
    """Examples from one text: its certain spans and disguised forms of them in the same
    place are personal data; other candidates, and harmless numbers put in the same places,
    are not. An address spelled out is left aside: it may well be personal. Of two phones or
    cards side by side, both are personal data, and spans of their parts are not.
    """
    rows = []
    certain = base_spans(text)
    for i, (kind, start, end) in enumerate(certain):
        before, after = text[max(0, start - 2 * CONTEXT):start], text[end:end + 2 * CONTEXT]
        for inner in (text[start:end], *_disguised(kind, text[start:end])):
            changed = before + inner + after
            whole = (kind, len(before), len(before) + len(inner))
            rows.append((features(changed, whole), 1.0))
            if kind in ("card", "phone"):
                # Beside its like: both are whole, what takes parts of them is not.
                changed = f"{before}{inner} {inner}{after}"
                second = (kind, whole[2] + 1, whole[2] + 1 + len(inner))
                rows += [(features(changed, span), 1.0) for span in (whole, second)]
                others = [
                    span for span in candidates(changed)
                    if whole[1] < span[2] and span[1] < second[2] and span[1:] not in (whole[1:], second[1:])
                ]
                # So is one beside a harmless number.
                _, number = _harmless(start + i)
                at = len(before) + len(number) + 1
                beside = f"{before}{number} {inner}{after}"
                rows.append((features(beside, (kind, at, at + len(inner))), 1.0))
                # A few are enough, so that they don't crowd out other examples.
                others.sort(key=lambda span: hashlib.sha256(repr((changed, span)).encode()).digest())
                rows += [(features(changed, span), 0.0) for span in others[:4]]
        for k in range(3):
            word, inner = _harmless(start + 3 * i + k)
            opening = f"{before[:-1]} {word} " if k else before
            changed = opening + inner + after
            for span in candidates(changed):
                if span[1] < len(opening) + len(inner) and span[2] > len(opening):
                    rows.append((features(changed, span), 0.0))
    covered = Covered(text, certain)
    for span in candidates(text):
        if span[0] != "email" and not covered.meets(span):
            rows.append((features(text, span), 0.0))
    return rows


def train(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_spans: int = SAMPLE_SPANS
) -> Booster | None:
    """The trees, fitted on a bounded sample; None where it has no span of both classes.

    About `sample_docs` documents, chosen by a hash of their text, are looked through,
    and `sample_spans` of their examples at most, again by hash, come to the driver. A
    fourth of them is kept for the calibration.
    """
    texts = docs.where(F.col("text").isNotNull()).select("text")
    total = texts.count()
    if not total:
        return None
    spread = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 30))
    chosen = texts.where(spread <= F.lit(int(min(1.0, sample_docs / total) * (1 << 30))))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Drawn by text and place: by their features, all examples alike would go together.
            rows = [
                (*row, zlib.crc32(text.encode("utf-8", "surrogatepass")) << 20 | i & 0xFFFFF)
                for text in batch["text"].to_pylist() for i, row in enumerate(training_rows(text))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _, _ in rows], type=pa.list_(pa.float64())),
                    pa.array([y for _, y, _ in rows], type=pa.float64()),
                    pa.array([place for _, _, place in rows], type=pa.int64()),
                ],
                names=["x", "y", "place"],
            )

    rows = (
        chosen.mapInArrow(examples, "x array<double>, y double, place bigint")
        .orderBy(F.xxhash64("place"), "x", "y").limit(sample_spans).collect()
    )
    y = np.array([row.y for row in rows])
    if len(set(y.tolist())) < 2 or len(y) < 40:
        return None
    x = np.array([row.x for row in rows])
    held = np.arange(len(y)) % 4 == 3
    return Booster().fit(x[~held], y[~held]).calibrate(x[held], y[held])


def all_spans(
    text: str, model: Booster | None, threshold: float = THRESHOLD
) -> tuple[list[Span], list[Span]]:
    """The certain spans, and all spans: certain ones, then by probability those
    candidates, of equal ones the longest, that overlap none chosen before."""
    certain = base_spans(text)
    if model is None:
        return certain, certain
    taken = Covered(text, certain)
    open_ones = [span for span in candidates(text) if not taken.meets(span)]
    added = []
    if open_ones:
        chance = model.probability(np.array([features(text, span) for span in open_ones]))
        for k in sorted(range(len(open_ones)), key=lambda k: (-chance[k], open_ones[k][1] - open_ones[k][2], open_ones[k])):
            if chance[k] < threshold:
                break
            if not taken.meets(open_ones[k]):
                taken.add(open_ones[k])
                added.append(open_ones[k])
    order = {kind: i for i, kind in enumerate(KINDS)}
    return certain, sorted([*certain, *added], key=lambda span: (order[span[0]], span[1]))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the
    whole stretch is replaced, named after the first."""
    if text is None:
        return None
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_personal_data(
    docs: DataFrame, threshold: float = THRESHOLD, model: Booster | None = None,
    with_text: bool = True,
) -> DataFrame:
    """doc_id, counts of certain spans by kind, their digest, all spans, and the redacted
    text, for every row of `docs`.

    Null and empty texts have no span; a null text stays null when redacted. Repeated
    rows are judged alike. Without a model given, one is trained on `docs` themselves;
    where they hold nothing to learn from, the certain spans are the result. The model,
    a few kilobytes, goes with the task; no row is shuffled.
    """
    model = train(docs) if model is None else model

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = [all_spans(text or "", model, threshold) for text in texts]
            counts = [
                pa.array([sum(span[0] == kind for span in certain) for certain, _ in found], pa.int64())
                for kind in KINDS
            ]
            digests = [hashlib.sha256(joined(certain).encode()).hexdigest() for certain, _ in found]
            columns = [
                batch["doc_id"], *counts, pa.array(digests, pa.string()),
                pa.array([joined(spans) for _, spans in found], pa.string()),
                pa.array([len(spans) - len(certain) for certain, spans in found], pa.int64()),
            ]
            if with_text:
                columns.append(pa.array(
                    [redact(text, spans) for text, (_, spans) in zip(texts, found, strict=True)],
                    pa.string(),
                ))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [
        "doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added",
        *(["redacted_text"] if with_text else []),
    ]
    types = ["bigint", *["bigint"] * len(KINDS), "string", "string", "bigint", *["string"] * with_text]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, types, strict=True))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(of, schema)
