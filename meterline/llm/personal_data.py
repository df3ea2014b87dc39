"""Personal data in texts: four patterns, and what a conditional random field over word shapes adds to them.

The field reads runs of neighbouring words that hold a digit or an at sign; no other word can be part of a finding.  It
is trained on a small labelled table: some made by rule, of every kind in several spellings and of plain numbers, so that none
depends on what a corpus happens to hold; and the runs of at most ``TRAINING_DOCS`` documents, as many of each kind in which
Spark finds that kind, however rare it is, labelled by the patterns.  Each finding comes once more in a spelling that the
patterns miss (a telephone number without plus, a card number with dots).

Rows: NULL text counts as empty; texts are searched whole, whatever their length; repeated rows are searched each, and
count once for the sample; a corpus without any finding has the field of the table made by rule.
"""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm import crf
from meterline.llm.common import smallest_hashes_by, written

KINDS = ("email", "ip", "card", "phone")
#: Documents that the labelled table is made of, a fifth for each kind and a fifth for any with a digit or an at sign, those
#: with the smallest hashes, and their characters at most.
TRAINING_DOCS = 600
TRAINING_CHARS = 10_000_000
#: Examples of the table made by rule, for each spelling.
MADE = 12
#: Where a document may hold a kind; the patterns decide.
CANDIDATES = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9]([ -]?[0-9]){15}",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "any": r"[0-9@]",
}
#: Longest run of tokens in the labelled table.
TRAINING_TOKENS = 60
N_FEATURES = 1 << 13

_SIGN = re.compile(r"[0-9@]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits would have started at its first digit.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        # Bounded by the last finding or at sign, so that a text is passed once.
        head = text[max(end, text.rfind("@", 0, at) + 1) : at]
        start = at - (len(head) - len(head.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four patterns, by kind, then start."""
    if not _SIGN.search(text):
        return []
    spans = [("email", *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, match[0])) <= 15:
            spans.append(("phone", *match.span()))
    return spans


# ---------------------------------------------------------------------------------------------------------------------
# Runs of words and their features.


def runs(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or an at sign that are one space apart."""
    found: list[list[int]] = []
    end = 0
    for match in _SIGN.finditer(text):
        if match.start() < end:
            continue
        start, end = match.start(), match.end()
        floor = found[-1][1] if found else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if found and start == found[-1][1] + 1 and text[start - 1] == " ":
            found[-1][1] = end
        else:
            found.append([start, end])
    return [tuple(run) for run in found]


def _shape(token: str) -> str:
    if token[0].isdigit():
        n = len(token)
        return f"9{n if n < 8 else 8 if n < 13 else 13 if n < 16 else 16 if n < 20 else 20}"
    if token[0].isalpha():
        return f"{'A' if token.isupper() else 'a'}{min(len(token), 4)}"
    return token


def _number(name: str) -> int:
    return crc32(name.encode("utf-8", "surrogatepass")) % N_FEATURES


def tokens_of(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Places of a run's tokens, and the numbers of their features."""
    tokens = [match.span() for match in _TOKEN.finditer(text, start, end)]
    shapes = ["^", *[_shape(text[a:b]) for a, b in tokens], "$"]
    gaps = [0] + [int(b[0] > a[1]) for a, b in zip(tokens, tokens[1:], strict=False)] + [0]
    checked: dict[int, str] = {}
    for match in re.finditer(r"[0-9](?:[ .-]?[0-9])*", text[start:end]):
        digits = re.sub(r"[ .-]", "", match[0])
        kind = f"{min(len(digits), 20)}{'v' if 13 <= len(digits) <= 19 and luhn(digits) else ''}"
        for place in range(match.start(), match.end()):
            checked[start + place] = kind
    rows = []
    for i, (a, b) in enumerate(tokens, 1):
        before, here, after = shapes[i - 1], shapes[i], shapes[i + 1]
        gap = f"{gaps[i - 1]}{gaps[i]}"
        own = text[a:b]
        worth = "" if not own[0].isdigit() else "v" if 13 <= b - a <= 19 and luhn(own) else "b" if len(own) <= 3 and int(own) <= 255 else "n"
        further = shapes[i + 2] if i + 2 < len(shapes) else "$"
        earlier = shapes[i - 2] if i > 1 else "^"
        rows.append(
            [
                _number(f"0{here}"),
                _number(f"1{here}{gap}"),
                _number(f"2{before}{gap}{here}"),
                _number(f"3{here}{gap}{after}"),
                _number(f"4{before}{gap}{here}{after}"),
                _number(f"5{here}{worth}"),
                _number(f"6{here}{gap}{checked.get(a, '')}"),
                _number(f"7{earlier}{before}{here}{gap}"),
                _number(f"8{here}{after}{further}{gap}"),
            ]
        )
    return tokens, np.array(rows, np.int32).reshape(-1, 9)


def _labels(tokens: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> np.ndarray:
    """0 outside, ``2 k + 1`` at the first token of kind ``k``, ``2 k + 2`` at its others."""
    labels = np.zeros(len(tokens), np.int64)
    for kind, start, end in spans:
        for i, (a, b) in enumerate(tokens):
            if a < end and b > start and not labels[i]:
                labels[i] = 2 * KINDS.index(kind) + (1 if a <= start else 2)
    return labels


def _other_spelling(kind: str, value: str, salt: int) -> str | None:
    """The same kind of data as the patterns do not know it."""
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "phone" and len(digits) >= 10:
        area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
        return (f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}")[salt % 3]
    if kind == "card":
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return None


def made_examples() -> list[tuple[str, str | None]]:
    """(value, kind or None) by a fixed rule: every kind in the spellings of patterns and others, and numbers that are none."""
    draw = random.Random(31)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 9)))

    def card(mark: str) -> str:
        body = draw.choice("3456") + digits(14)
        whole = next(body + last for last in "0123456789" if luhn(body + last))
        return mark.join(whole[i : i + 4] for i in range(0, 16, 4))

    found: list[tuple[str, str | None]] = []
    for _ in range(MADE):
        area, first, last = draw.choice("23456789") + digits(2), digits(3), digits(4)
        found += [(spelled, "phone") for spelled in (f"+1 ({area}) {first}-{last}", f"+{digits(2)} {area} {first} {last}", f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}")]
        found += [(card(mark), "card") for mark in ("", " ", "-", ".")]
        found.append((".".join(str(draw.randint(0, 255)) for _ in range(4)), "ip"))
        found += [(f"{word()}{mark}{word()}@{word()}.{draw.choice(('org', 'com', 'co.uk'))}", "email") for mark in (".", "_", "")]
        found += [(plain, None) for plain in (str(draw.randint(1, 2100)), f"{draw.randint(1, 99)}.{digits(2)}", f"{draw.randint(1, 9)},{digits(3)}")]
        found += [(plain, None) for plain in (f"{draw.randint(1, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 9)}", f"20{digits(2)}-{digits(2)}-{digits(2)}", word() + digits(2), digits(6))]
    return found


def labelled_runs(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    sequences, labels = [], []

    def add(text: str, start: int, end: int, spans: list[tuple[str, int, int]]) -> None:
        tokens, rows = tokens_of(text, start, end)
        if 0 < len(tokens) <= TRAINING_TOKENS:
            sequences.append(rows)
            labels.append(_labels(tokens, spans))

    for value, kind in made_examples():
        add(value, 0, len(value), [(kind, 0, len(value))] if kind else [])
    for text in texts:
        spans = base_spans(text)
        for start, end in runs(text):
            own = [s for s in spans if s[1] < end and s[2] > start]
            add(text, start, end, own)
            for kind, a, b in own:
                other = _other_spelling(kind, text[a:b], len(sequences))
                if other is None or a < start or b > end:
                    continue
                longer = len(other) - (b - a)
                moved = [(k, x - start + longer * (x >= b), y - start + longer * (y >= b)) for k, x, y in own]
                spelled = text[start:a] + other + text[b:end]
                add(spelled, 0, len(spelled), moved)
    return sequences, labels


def training_texts(docs: DataFrame, key: str, text: str) -> list[str]:
    """Whole texts of a bounded sample, in a fixed order."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = F.array_compact(F.array(*[F.when(F.col("text").rlike(pattern), kind) for kind, pattern in CANDIDATES.items()]))
    rows = rows.where(F.col("text").rlike(CANDIDATES["any"])).withColumn("kind", F.explode(kinds))
    sample = written(smallest_hashes_by(rows, "kind", TRAINING_DOCS // len(CANDIDATES), "key", "text"), "sample")
    so_far = Window.partitionBy("group").orderBy("hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounded = sample.withColumn("upto", F.sum(F.length("text")).over(so_far))
    bounded = bounded.where(F.col("upto") <= TRAINING_CHARS // len(CANDIDATES))
    return [row["text"] for row in bounded.select("group", "hash", "text").orderBy("group", "hash").collect()]


def fitted(docs: DataFrame, key: str, text: str) -> crf.Model:
    """The field trained on the table made by rule and on a bounded sample of documents."""
    sequences, labels = labelled_runs(list(dict.fromkeys(training_texts(docs, key, text))))
    n_labels = 2 * len(KINDS) + 1
    allowed = np.ones((n_labels, n_labels), bool)
    for kind in range(len(KINDS)):
        allowed[:, 2 * kind + 2] = False
        allowed[[2 * kind + 1, 2 * kind + 2], 2 * kind + 2] = True
    first = np.array([label == 0 or label % 2 == 1 for label in range(n_labels)])
    return crf.train(sequences, labels, N_FEATURES, n_labels, allowed, first)


def _plausible(kind: str, value: str) -> bool:
    digits = sum(map(str.isdigit, value))
    return {
        "email": "@" in value[1:-1],
        "ip": value.count(".") == 3,
        "card": 13 <= digits <= 19,
        "phone": 7 <= digits <= 15,
    }[kind]


def all_spans(texts: list[str], model: crf.Model | None) -> list[tuple[list, list]]:
    """For each text the patterns' spans and all spans; the field's are added where they touch none of the patterns'."""
    base = [base_spans(text) for text in texts]
    if model is None:
        return [(spans, spans) for spans in base]
    places = [(i, *run) for i, text in enumerate(texts) if _SIGN.search(text) for run in runs(text)]
    read = [tokens_of(texts[i], start, end) for i, start, end in places]
    more: list[list] = [[] for _ in texts]
    for (i, _, _), (tokens, _), labels in zip(places, read, crf.decode(model, [rows for _, rows in read]), strict=True):
        at = 0
        while at < len(labels):
            if labels[at] == 0:
                at += 1
                continue
            kind, end = (labels[at] - 1) // 2, at + 1
            while end < len(labels) and labels[end] == 2 * kind + 2:
                end += 1
            start, stop = tokens[at][0], tokens[end - 1][1]
            free = all(stop <= a or start >= b for _, a, b in base[i])
            if free and _plausible(KINDS[kind], texts[i][start:stop]):
                more[i].append((KINDS[kind], start, stop))
            at = end
    order = lambda span: (KINDS.index(span[0]), span[1])
    return [(spans, sorted(spans + added, key=order)) for spans, added in zip(base, more, strict=True)]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_personal_data(docs: DataFrame, model: crf.Model | None, key: str, text: str) -> DataFrame:
    """doc_id, the number of pattern findings by kind, the SHA-256 of their list, and the list of all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches):
        for batch in batches:
            found = all_spans(batch["text"].tolist(), shared.value)
            counts = {f"n_{kind}": [sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS}
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    **counts,
                    "base_sha256": [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found],
                    "spans": [_joined(spans) for _, spans in found],
                }
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "doc_id bigint, " + ", ".join(f"n_{kind} bigint" for kind in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInPandas(search, schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind in brackets; where spans overlap, the first names the kind."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redacted(text: Column, model: crf.Model | None) -> Column:
    """The text without personal data; NULL stays NULL."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        found = all_spans(texts.fillna("").tolist(), model)
        return pd.Series(
            [None if old is None else redact(old, spans) for old, (_, spans) in zip(texts, found, strict=True)], dtype=object
        )

    return clean(text)
