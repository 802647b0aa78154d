"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier is trained on what they imply.

1. Candidates. Spans in four base formats (email, ip, card, phone), and looser spans: addresses written with "at" and
   "dot", dots in brackets, national phone numbers, card numbers in groups.
2. Votes. Each candidate gets a vote (yes, no, abstain) from each labeler: strict format, shape (digits, ranges,
   checksum), gazetteer (domains, calling codes, card issuers), context words before it, and its neighbour characters.
3. Expectation-maximisation. The votes of all documents are counted by kind and pattern, which bounds their number
   whatever the corpus holds; EM on those counts estimates each labeler's reliability and a probability per pattern.
4. Classifier. A logistic regression per candidate over kind, votes and size, fitted to those probabilities, accepts or
   rejects the looser spans. Base spans are always kept.

Null text is empty. Positions are code points, ends exclusive. Rows are independent: repeated rows, ties and null ids
keep their own result; an empty table gives an empty result; extra columns are left out by ``found`` and kept by
``masked``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import arrow_map, column_of, stored, table, texts_of

KINDS = ["email", "ip", "card", "phone"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOOSE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20at\x20|\x20?@\x20?)[A-Za-z0-9-]{1,63}"
        r"(?:(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,63}){1,4}(?![A-Za-z0-9-])"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20?\[dot\]\x20?)[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[._/]|\x20\x20|\x20-\x20)[0-9]{4,6}(?:(?:[._/]|\x20\x20|\x20-\x20)[0-9]{3,5}){1,2}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[\x20.-])?(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}

#: Gazetteers and context words: fixed lists of the labelers.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "io", "co", "info", "de", "fr", "es", "uk", "eu", "example", "test"}
CALLING_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49"}
CALLING_CODES |= {"51", "52", "54", "55", "56", "57", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91"}
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|36|6011|65")
CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write", "correo", "courriel", "kontakt", "schreib"},
    "ip": {"ip", "host", "server", "address", "addr", "adresse", "client", "login", "peer"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta", "pay"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "anruf", "telefon", "llame", "appelez"},
}
COUNTER_CUES = {"version", "isbn", "issn", "order", "invoice", "id", "ref", "no", "nr", "section", "chapter", "page", "doi", "release"}
WORD_BEFORE = re.compile(r"[A-Za-z-]+")

YES, NO, ABSTAIN = 2, 1, 0
LABELERS = 5


def luhn(digits: str) -> bool:
    total = 0
    for place, one in enumerate(reversed(digits)):
        value = int(one) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Base addresses. The part before each @ is the run of its characters since the last address, so time is linear."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        match = AT_DOMAIN.match(text, at) if begin < at else None
        if match:
            done = match.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base formats, in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


#: What a text must hold for a looser span of the kind to exist, so that most texts skip the looser patterns.
HINTS = {
    # The middle of LOOSE["email"]: any of its forms of at, a label, and the beginning of any of its forms of dot.
    "email": re.compile(r"(?:@\x20?|\x20at\x20|[(\[{]\x20?at\x20?[)\]}]\x20?)[A-Za-z0-9-]{1,63}(?:\.|\x20dot\x20|\x20?[(\[{]\x20?dot)"),
    "ip": re.compile(r"[0-9][\[(]\.|[0-9]\x20?\[dot"),
    "card": re.compile(r"[0-9]{4}(?:[._/]|\x20[\x20-])"),
    "phone": re.compile(r"[0-9]{3}[\x20.-][0-9]{4}"),
}


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of looser formats that touch no span found before. Matches and spans are merged in order."""
    taken, found = sorted((a, b) for a, _, b in base), []
    for kind, name in enumerate(KINDS):
        if not HINTS[name].search(text):
            continue
        free, at, reach = [], 0, 0  # reach: the furthest end of the spans that start before the match ends
        for m in LOOSE[name].finditer(text):
            while at < len(taken) and taken[at][0] < m.end():
                reach = max(reach, taken[at][1])
                at += 1
            if reach <= m.start():
                free.append(m.span())
        found += [(a, kind, b) for a, b in free]
        taken = sorted(taken + free)
    return sorted(found)


def votes(text: str, start: int, kind: int, end: int, base: bool) -> list[int]:
    """One vote of each labeler."""
    span, name = text[start:end], KINDS[kind]
    digits = digits_of(span)
    strict = YES if base else ABSTAIN
    if name == "email":
        label = re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]} "))[-1].lower()
        shape = YES if not span.startswith(".") and ".." not in span else NO
        listed = YES if label in TOP_DOMAINS else (NO if label.isdigit() else ABSTAIN)
    elif name == "ip":
        parts = [int(p) for p in re.findall("[0-9]+", span)[:4]]
        shape = YES if all(p <= 255 for p in parts) else NO
        listed = NO if parts[0] == 0 or len(set(parts)) == 1 else ABSTAIN
    elif name == "card":
        shape = YES if 12 <= len(digits) <= 19 and luhn(digits) else NO
        listed = YES if ISSUERS.match(digits) else NO
    else:
        shape = YES if 9 <= len(digits) <= 15 else NO
        code = digits.lstrip("0")
        listed = YES if span[0] in "+0" and any(code[:n] in CALLING_CODES for n in (1, 2)) else ABSTAIN
    before = [w.lower() for w in WORD_BEFORE.findall(text[max(0, start - 40) : start])[-4:]]
    context = YES if CUES[name] & set(before) else (NO if COUNTER_CUES & set(before[-2:]) else ABSTAIN)
    left, right = text[start - 1 : start], text[end : end + 1]
    near = NO if left.isalnum() or right.isalnum() or left in ("#", "=", "/") and left else YES
    return [strict, shape, listed, context, near]


def pattern(kind: int, cast: list[int], length: int) -> int:
    """Kind, votes and size class as one number: at most 4 * 3^5 * 8 values."""
    code = kind
    for vote in cast:
        code = code * 3 + vote
    return code * 8 + min(7, length // 4)


def parts_of(code: int) -> tuple[int, list[int], int]:
    code, size = divmod(code, 8)
    cast = []
    for _ in range(LABELERS):
        code, vote = divmod(code, 3)
        cast.append(vote)
    return code, cast[::-1], size


def expectation_maximisation(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Probability that a span of each pattern is personal data: two classes, labelers independent given the class."""
    kinds = np.array([parts_of(c)[0] for c in counts])
    cast = np.array([parts_of(c)[1] for c in counts])
    n = np.array(list(counts.values()), float)
    # Start: the balance of votes. Prior per kind; vote probabilities per labeler and class, shared by the kinds.
    chance = 1 / (1 + np.exp(-((cast == YES).sum(1) - (cast == NO).sum(1)).astype(float)))
    for _ in range(rounds):
        weight = np.stack([n * (1 - chance), n * chance])
        log = np.zeros((2, len(n)))
        for k in range(len(KINDS)):
            of = kinds == k
            share = (weight[:, of].sum(1) + 1) / (n[of].sum() + 2)
            log[:, of] += np.log(share)[:, None]
        for j in range(LABELERS):
            for c in (0, 1):
                held = np.array([weight[c, cast[:, j] == v].sum() for v in (ABSTAIN, NO, YES)]) + 1
                log[c] += np.log(held / held.sum())[cast[:, j]]
        chance = 1 / (1 + np.exp(np.clip(log[0] - log[1], -30, 30)))
    return dict(zip(counts, chance.tolist()))


def features(codes: list[int]) -> np.ndarray:
    rows = []
    for code in codes:
        kind, cast, size = parts_of(code)
        row = [1.0, size / 8] + [float(kind == k) for k in range(len(KINDS))]
        for vote in cast:
            row += [float(vote == YES), float(vote == NO)]
        rows.append(row)
    return np.array(rows)


def classifier(counts: dict[int, int], chance: dict[int, float], steps: int = 30, ridge: float = 1.0) -> dict[int, float]:
    """Logistic regression on the counted patterns, each weighing as the spans it stands for; probability by pattern.

    Very large counts are scaled by one common factor: the weights between patterns stay.
    """
    codes = list(counts)
    x, target = features(codes), np.array([chance[c] for c in codes])
    n = np.array([counts[c] for c in codes], float)
    n *= min(1.0, 1e6 / n.max())
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (target - p)) - ridge * w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return dict(zip(codes, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))


FIELDS = {"start": T.IntegerType(), "kind": T.IntegerType(), "end": T.IntegerType(), "base": T.BooleanType(), "pattern": T.IntegerType()}
SPANS = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in FIELDS.items()]))


def candidates(documents: DataFrame, keep: list[str], name: str = "spans") -> DataFrame:
    """The columns ``keep`` of each document, and ``name``: (kind, start, end, base, pattern) of every candidate."""

    def scan(batch):
        out = []
        for text in texts_of(batch):
            base = base_spans(text)
            spans = []
            for is_base, found in ((True, base), (False, loose_spans(text, base))):
                for start, kind, end in found:
                    code = pattern(kind, votes(text, start, kind, end, is_base), end - start)
                    spans.append({"start": start, "kind": kind, "end": end, "base": is_base, "pattern": code})
            out.append(sorted(spans, key=lambda s: (s["start"], s["kind"])))
        return {n: column_of(batch, n) for n in keep} | {name: out}

    schema = T.StructType([documents.schema[n] for n in keep] + [T.StructField(name, SPANS)])
    return arrow_map(documents.select(*dict.fromkeys([*keep, "text"])), schema, scan)


def trained(spans: DataFrame, least: float = 0.5) -> set[int]:
    """Patterns of looser spans that the classifier accepts, from rows of ``candidates``."""
    rows = spans.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.pattern: r.n for r in rows.collect()}  # bounded by the number of patterns
    if not counts:
        return set()
    chance = classifier(counts, expectation_maximisation(counts))
    return {code for code, p in chance.items() if p >= least}


def found(documents: DataFrame) -> DataFrame:
    """Per document: the base counts and digest, and all accepted spans as kind:start:end."""
    spans = stored(candidates(documents, ["doc_id"]))
    accepted = trained(spans)

    def report(batch):
        out = defaultdict(list)
        for row in column_of(batch, "spans").to_pylist():
            base = [s for s in row if s["base"]]
            for kind, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(s["kind"] == kind for s in base))
            text = ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in base)
            out["base_sha256"].append(sha256(text.encode()).hexdigest())
            out["spans"].append(",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in row if s["base"] or s["pattern"] in accepted))
        return out | {"doc_id": column_of(batch, "doc_id")}

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return arrow_map(spans, schema, report)


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with every accepted span of ``text`` replaced by its kind in angle brackets; null text stays null.

    Texts are scanned once: the rows are stored with their candidates, and masked from those.
    """
    rows = stored(candidates(documents, documents.columns, "__pii_spans"))
    accepted = trained(rows.select(F.col("__pii_spans").alias("spans")))

    def mask(batch):
        out = []
        for text, found in zip(column_of(batch, "text").to_pylist(), column_of(batch, "__pii_spans").to_pylist()):
            spans = [(s["start"], s["kind"], s["end"]) for s in found if s["base"] or s["pattern"] in accepted]
            if spans:
                parts, done = [], 0
                for start, kind, end in spans:
                    if end <= done:
                        continue
                    if start >= done:
                        parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
                    done = end  # what overlaps a masked span goes with it
                text = "".join([*parts, text[done:]])
            out.append(text)
        return {n: column_of(batch, n) for n in batch.schema.names} | {"text": out}

    return arrow_map(rows, documents.schema, mask)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"))
