"""Secrets in text: fixed patterns, and strings that a dictionary-primed compressor finds new.

The fixed patterns find assignments, access keys and long hexadecimal runs. Beside them, every run of ``MIN_CANDIDATE`` and
more characters within ``NEAR`` characters before or after a sensitive word is a candidate; runs end at white space, quotes,
brackets, commas, semicolons and sensitive words. Zstandard, primed with a dictionary of common identifiers, compresses the
text around it once without and once with the candidate. A candidate that the dictionary and its surroundings explain (an
identifier, a path) costs a few bytes; a random key costs nearly its length. The surroundings are taken without the other
candidates and without copies of the candidate, so that a key that stands twice, or beside keys of the same stem, does not
explain itself. Strings whose marginal bytes at their first place reach ``MIN_COST`` of their length are reported as kind
``novel`` wherever they stand in the text, also away from sensitive words, unless they overlap a span of a fixed pattern.

Ordinary words and numbers (letters in parts of four and more on average, digits with separators) cost nearly their length
too where the text around has not used them ("different" costs 1.0 a character), so the cost cannot tell them from keys. They
are candidates only as the value of a sensitive word (``pwd: ...``, ``auth = ...``). E-mail addresses are no candidates.

Every row is judged alone, over its whole text, so the scan needs no shuffle. A NULL text is empty and has no spans.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.llm.text import packed, unpacked

#: In the order of spans that start at the same place.
KINDS = ("assign", "access", "hex", "novel")
SPANS = "array<struct<kind: string, start: long, end: long>>"

# Words that name a secret, and identifiers common around them.
ASSIGNED = ("password", "passwd", "secret", "token", "api_?key")
SENSITIVE = (
    "access_key", "accesskey", "api_key", "apikey", "auth", "authorization", "bearer", "client_secret", "credential",
    "key", "passphrase", "passwd", "password", "private", "pwd", "secret", "session", "signature", "token",
)
IDENTIFIERS = (
    "access_key access_token account algorithm api_key apikey application authorization aws_access_key_id "
    "aws_secret_access_key base64 basic bearer bucket certificate client_id client_secret config connection const "
    "content-type credentials database default development docker email encoding encrypted endpoint environment error "
    "example export false function github header host http https id_rsa import json key kubernetes localhost login "
    "message method module mongodb mysql name null oauth object openssl options package passphrase password path port "
    "postgres private_key process production profile project public_key python redis refresh_token region request "
    "response return root secret secret_key server service session session_id setting signature slack source ssh-rsa "
    "staging string stripe system test token true undefined update url user username utf-8 value var version "
    "version1 version2 webhook x-api-key abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "00000000000000000000000000000000 11111111-1111-1111-1111-111111111111 xxxxxxxxxxxxxxxxxxxxxxxx v1 v2 sha256 md5"
)

#: Characters of text on either side of a candidate that it is compressed with.
AROUND = 256
#: How far from a candidate its sensitive word may be, on either side.
NEAR = 40
#: Marginal bytes a character from which a candidate is reported.
MIN_COST = 0.55
MIN_CANDIDATE = 8


def _either_case(word: str) -> str:
    return "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in word)


_ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, ASSIGNED)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
_HEX_BYTE = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
_NEAR = re.compile("(?:" + "|".join(map(_either_case, sorted(SENSITIVE, key=len, reverse=True))) + ")")
_RUN = re.compile(r"""[^\s"'`<>(){}\[\],;]{%d,}""" % MIN_CANDIDATE)
#: Where a run is cut into names and values, and the parts of an address.
_QUERY = re.compile(r"[?&](?=[\w.-]+=)")
_ADDRESS = re.compile(r"[/?&=#]+")
#: A name before a value, what stands between a sensitive word and its value, and characters around a candidate.
_NAME = re.compile(r"[-_.:=]*(?:[A-Za-z_.-]+[:=]+(?=[^:=]))?[-_.:=]*")
_ASSIGNS = re.compile(r"""[A-Za-z_-]*["'`\])]*\s*[:=]+>?\s*["'`(\[{]*""")
_END = ".:"
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_A-Za-z]+")
_NUMBER = re.compile(r"[\d.:/+%$€#-]+")
_EMAIL = re.compile(r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}")


def _has_hex_run(text: str, n: int = 24) -> bool:
    """Whether some ``n`` (24) bytes in a row are hexadecimal digits, by doubling."""
    a = _HEX_BYTE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    for step in (1, 2, 4, 8):
        a = a[:-step] & a[step:] if len(a) > step else a[:0]
    return bool(len(a) > 8 and (a[:-8] & a[8:]).any())


def base_spans(text: str, lower: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, kind as a place in ``KINDS``."""
    lower, found = text.lower() if lower is None else lower, []
    if any(h in lower for h in _ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if len(text) >= 24 and _has_hex_run(text):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


class Novelty:
    """Marginal compressed bytes of strings, given an identifier dictionary and the text around them."""

    def __init__(self, dictionary: str = IDENTIFIERS):
        content = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compress = zstandard.ZstdCompressor(
            level=9, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False
        ).compress

    def cost(self, before: str, candidate: str, after: str) -> int:
        without, full = before + " " + after, before + candidate + after
        size = lambda t: len(self._compress(t.encode("utf-8", "surrogatepass")))
        # around is given first, so that what it shares with the candidate is known
        return size(without + full) - size(without + before + after)

    def spans(self, text: str, taken: list[tuple[int, int, int]], lower: str | None = None) -> list[tuple[int, int, int]]:
        lower, found = text.lower() if lower is None else lower, []
        if not any(w in lower for w in SENSITIVE):
            return found
        taken = [(x, y) for x, _, y in taken]
        open_runs = _apart(((a, b) for a, b, near, value in runs(text) if near and (value or not ordinary(text[a:b]))), taken)
        first: dict[str, int] = {}
        bare, at = [], 0
        for a, b in open_runs:
            if _EMAIL.fullmatch(text, a, b):
                continue
            first.setdefault(text[a:b], a)
            bare += [text[at:a], " " * (b - a)]
            at = b
        around = "".join([*bare, text[at:]])
        novel = {s for s, a in first.items() if self._is_novel(around, s, a)}
        if novel:
            found = [(a, 3, b) for a, b in _apart(((a, b) for a, b, _, _ in runs(text)), taken) if text[a:b] in novel]
        return found

    def _is_novel(self, around: str, s: str, a: int) -> bool:
        """Whether the candidate at ``a`` is new to the text around it, which holds no other candidate."""
        b, n = a + len(s), AROUND + len(s)
        before = around[max(0, a - n) : a].replace(s, " ")[-AROUND:]
        after = around[b : b + n].replace(s, " ")[:AROUND]
        return self.cost(before, s, after) >= MIN_COST * len(s)


def _apart(spans: Iterable[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans, in order, that overlap none of those taken, which come by their starts."""
    i, end = 0, 0
    for a, b in spans:
        while i < len(taken) and taken[i][0] < b:
            end = max(end, taken[i][1])
            i += 1
        if end <= a:
            yield a, b


def ordinary(s: str) -> bool:
    """Whether a run has the form of words or of a number."""
    if any(c.isdigit() for c in s):
        return _NUMBER.fullmatch(s) is not None
    letters = sum(map(str.isalpha, s))
    return letters >= 4 * len(_PART.findall(_accents_gone(s)))


def _accents_gone(s: str) -> str:
    """Letters other than ASCII as lower or upper case ASCII, so that they do not end a part."""
    return s if s.isascii() else "".join(c if c.isascii() or not c.isalpha() else "A" if c.isupper() else "a" for c in s)


def runs(text: str) -> Iterator[tuple[int, int, bool, bool]]:
    """(start, end, whether a sensitive word is near, whether it is the value of one) of all runs, in order."""
    before = None
    for near in [*_NEAR.finditer(text), None]:
        stop = near.start() if near else len(text)
        for m in _RUN.finditer(text, before or 0, stop):
            for a, b in _parts(text, m.start(), m.end()):
                if b - a >= MIN_CANDIDATE:
                    after = before is not None and a - before <= NEAR
                    close = after or near is not None and stop - b <= NEAR
                    yield a, b, close, after and _ASSIGNS.fullmatch(text, before, a) is not None
        if near:
            before = near.end()


def _parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    cut = _ADDRESS if "://" in text[start:end] else _QUERY
    edges = [start, *(x for m in cut.finditer(text, start, end) for x in m.span()), end]
    for a, b in zip(edges[::2], edges[1::2]):
        a = _NAME.match(text, a, b).end()
        while b > a and text[b - 1] in _END:
            b -= 1
        yield a, b


def all_spans(text: str, novelty: Novelty) -> list[tuple[int, int, int]]:
    lower = text.lower()
    base = base_spans(text, lower)
    return sorted(base + novelty.spans(text, base, lower))


def _row(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]


def secret_spans(text: Column) -> Column:
    """All spans of a text, by start and then kind."""

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        novelty = Novelty()
        for texts in batches:
            yield pd.Series([_row(all_spans(t, novelty)) for t in texts], dtype=object)

    return scan(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row."""
    return docs.select("doc_id", secret_spans(F.col("text")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of the result of ``scan``."""
    told = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("spans", lambda x: x["kind"] != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", told), ",").alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", length: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``mark``; ``length``, if there is such a column, follows the text."""

    @F.pandas_udf("string")
    def cover(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        novelty = Novelty()
        for texts in batches:
            out = []
            for t in texts:
                if t is not None:
                    parts, at = [], 0
                    for a, _, b in all_spans(t, novelty):
                        if b > at:
                            parts += [t[at:a], mark] if a >= at else []
                            at = b
                    t = "".join([*parts, t[at:]]) if parts else t
                out.append(t)
            yield pd.Series(out, dtype=object)

    rows = packed(docs)
    rows = rows.withColumn("covered", cover("doc.text"))
    changed = {"text": F.col("covered")}
    if length in docs.columns:
        changed[length] = F.when(F.col("covered").isNull(), F.col("doc")[length]).otherwise(F.length("covered").cast("long"))
    return unpacked(rows, docs, changed)
