"""Secret scans: fixed patterns, and strings in a sensitive context that a primed compressor cannot predict.

The base patterns find assignments to password-like names, access key ids and long hexadecimal strings. Beyond them, each
long token of letters and digits, or of capitals and small letters, in the context of a sensitive word is a candidate. The context is
the word's line, ``CONTEXT_LINES`` lines on either side, and lines that follow as one long token each; that of a private key
reaches from its BEGIN to its END. The novelty is what the candidate adds to the compressed size of its surroundings in the
context, by a Zstandard compressor primed with common code and identifiers: (size of the surroundings with it) - (size of the
surroundings with a gap in its place), in bits per character. Words, paths and identifiers add little; random strings add
nearly their entropy, and those with ``MIN_BITS`` or more are reported as kind novel.

Spans are in code points, end exclusive. The time grows in proportion to the text, whatever number of BEGIN lines, candidates and
spans it holds; very long texts are scanned whole. Defined cases: a null or empty text has no spans; matches of different
kinds may overlap, but a novel span never overlaps a base span; repeated rows give equal results; an empty table
gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns with their least lengths, the kinds in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ("assign", "access", "hex", "novel")

# Words that make a line sensitive, and text that primes the compressor.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "private key", "private_key", "bearer",
             "authorization", "access_key", "access key", "client_id", "signature", "passphrase", "auth_", "akia", "connection string")
PRIMER = (" function return class import export const default public static private protected void string number boolean object "
          "undefined null true false this self def lambda yield async await promise request response header content type length "
          "application json xml html http https www com org net user username email address account customer config configuration "
          "settings environment production development staging localhost server client database connection string host port name "
          "value index item items list array length size count total message error exception warning info debug trace level logger "
          "password passwd secret token api_key apikey access_key credentials authorization bearer signature private public key "
          "getElementById querySelector addEventListener toString parseInt camelCase snake_case kebab-case __init__ __main__ "
          "/usr/local/bin /etc/config /home/user /var/log/ C:\\Program Files\\ example.com 127.0.0.1 0123456789 abcdefghijklmnopqrstuvwxyz "
          "ABCDEFGHIJKLMNOPQRSTUVWXYZ your-password-here changeme placeholder xxxxxxxxxxxxxxxx 0000000000000000 ").encode()
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_CLASSES = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
_TOKEN_LINE = re.compile(r"\n[\x20\t]*[A-Za-z0-9+/_=-]{16,}[\x20\t\r]*(?=\n|$)")
_KEY_BEGIN = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_KEY_END = re.compile(r"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
CONTEXT_LINES = 4
SURROUNDING = 512
MIN_BITS = 3.5
_PREFILTER = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Novelty:
    """Marginal compressed bits per character of a string among its surroundings."""

    def __init__(self):
        data = zstandard.ZstdCompressionDict(PRIMER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.pack = zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_checksum=False).compress

    def __call__(self, before: str, candidate: str, after: str) -> float:
        around = len(self.pack((before + after).encode("utf-8", "replace")))
        return 8 * (len(self.pack((before + candidate + after).encode("utf-8", "replace"))) - around) / len(candidate)


def contexts(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches of whole lines around sensitive words, in order, without overlaps."""
    found, line_end, walked = [], -1, (0, -1)
    for word in _PREFILTER.finditer(text):
        if word.start() < line_end:
            continue
        start = word.start()
        for _ in range(CONTEXT_LINES + 1):
            start = text.rfind("\n", 0, max(start, 0))
            if start < 0:
                break
        line_end = text.find("\n", word.end())
        line_end = end = len(text) if line_end < 0 else line_end
        for _ in range(CONTEXT_LINES):
            end = text.find("\n", end + 1)
            if end < 0:
                end = len(text)
                break
        # Lines of tokens that hold sensitive words themselves are walked over once.
        if walked[0] <= end <= walked[1]:
            end = walked[1]
        else:
            first = end
            while more := _TOKEN_LINE.match(text, end):
                end = more.end()
            walked = (first, end)
        found.append((start + 1, end))
    if found:
        ends = list(_KEY_END.finditer(text))
        at = 0
        for begin in _KEY_BEGIN.finditer(text) if ends else ():
            while at < len(ends) and ends[at].start() < begin.end():
                at += 1
            if at == len(ends):
                break
            found.append((begin.start(), ends[at].end()))
    merged = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: Novelty) -> list[tuple[int, int, str]]:
    """Candidates around sensitive words that the primed compressor cannot predict. Contexts and base spans are walked together, in order."""
    found, at, covered = [], 0, 0
    for start, end in contexts(text):
        for m in CANDIDATE.finditer(text, start, end):
            # ``covered`` is the end of the base spans that start before the candidate ends; candidates do not overlap, so a
            # base span that reaches beyond its start overlaps it.
            while at < len(base) and base[at][0] < m.end():
                covered = max(covered, base[at][1])
                at += 1
            mixed = sum(c.search(m[0]) is not None for c in _CLASSES)
            if mixed < 2 or covered > m.start():
                continue
            before = text[max(start, m.start() - SURROUNDING):m.start()]
            after = text[m.end():min(end, m.end() + SURROUNDING)]
            if novelty(before, m[0], after) >= MIN_BITS:
                found.append((m.start(), m.end(), "novel"))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(text: str | None, novelty: Novelty) -> tuple:
    """(n_assign, n_access, n_hex, n_novel, base_sha256, spans)."""
    text = text or ""
    base = base_spans(text)
    every = sorted(base + novel_spans(text, base, novelty), key=lambda s: (s[0], KINDS.index(s[2])))
    counts = [sum(s[2] == kind for s in every) for kind in KINDS]
    return *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans) of every document."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    names = ["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            columns = list(zip(*(scan(t.as_py(), novelty) for t in batch.column(1)))) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns))],
                                             names=["doc_id", *names])

    return chosen.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
