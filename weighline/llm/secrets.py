"""Operator 3: secret scans with structural confirmation.

Base patterns give assignments, access ids and hex runs.  Long base64 and hex candidates are then decoded, and
reported only if what they decode to parses: an ASN.1 key (nested lengths that fill their parents exactly, down to the
integers of a key), an OpenSSH private key (its magic and every length-prefixed field), or a signed token (a header
that is a JSON object with an algorithm, a payload that is a JSON object).

Every text is scanned whole and alone, so nothing is shuffled.  Offsets are code points, ends exclusive.

Defined results.  Null text is empty; texts without findings give zero counts, empty span lists and the hash of the
empty string.  Repeated rows give repeated results.  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import base64
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weighline.llm import common as C

#: The base patterns, with the fewest characters of what must be long enough.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a greedy run is maximal, so the length can be asked for in the pattern
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
#: Kinds in the order in which spans with one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "key", "ssh", "jwt")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
#: Base64 of a JSON object's opening brace and what may follow it.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e(?:yJ|yA|wo|w0|wk)[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: A key in lines of base64, as tools write it; in a quoted string, line ends are a backslash and a letter.
LINE_ENDS = re.compile(r"\s+|\\+[nr]")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*)KEY-----(?=\s|\\)((?:[A-Za-z0-9+/=\s]|\\+[nr])+)-----END \1KEY-----")
#: Within a candidate: a piece between signs, and where base64 of an ASN.1 sequence or of an OpenSSH key may begin after a sign.
PIECE = re.compile(r"[A-Za-z0-9]{40,}")
BEGINS = re.compile(r"(?<![A-Za-z0-9])(?=M[A-P][A-Za-z0-9+/_-]{6}|b3BlbnNzaC1rZXktdjEA)")

NOT_HEX = re.compile(r"[^0-9A-Fa-f]")
SSH_MAGIC = b"openssh-key-v1\x00"
#: No key format has as many elements on one level, or keys in one file.
MOST_PARTS = 64

_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                  ("base_sha256", pa.string()), ("spans", pa.string()), ("n_confirmed", pa.int64())])
OUT_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _element(data, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the ASN.1 element at ``at``, if it lies within ``end``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n, at = int.from_bytes(data[at:at + size], "big"), at + size
    return (tag, at, at + n) if at + n <= end else None


def _elements(data, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at``..``end`` exactly; None if they do not, or are more than any key has."""
    out = []
    while at < end:
        e = _element(data, at, end)
        if e is None or len(out) == MOST_PARTS:
            return None
        out.append(e)
        at = e[2]
    return out


def is_key(data) -> bool:
    """A sequence that fills the data and has the elements of a private or public key."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts:
        return False
    tags = [t for t, _, _ in parts]
    if tags[0] == 0x02 and len(tags) >= 6 and set(tags) == {0x02}:  # version and the integers of a key
        return parts[0][2] - parts[0][1] == 1
    if tags[:3] == [0x02, 0x30, 0x04]:  # version, algorithm, a key within an octet string
        algorithm = _elements(data, parts[1][1], parts[1][2])
        inner = _elements(data, parts[2][1], parts[2][2])
        return bool(algorithm) and algorithm[0][0] == 0x06 and bool(inner)
    if tags[:2] == [0x02, 0x04] and data[parts[0][1]:parts[0][2]] == b"\x01":  # version 1 and a curve's number
        return parts[1][2] - parts[1][1] in (28, 32, 48, 66)
    if tags == [0x30, 0x03]:  # algorithm and a bit string
        algorithm = _elements(data, parts[0][1], parts[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def ssh_length(data) -> int | None:
    """Bytes of the OpenSSH key at the start of the data: the magic, then cipher, derivation and options, a count, as many
    public keys and the private part, all with lengths before them; None if they do not fit."""
    if bytes(data[:len(SSH_MAGIC)]) != SSH_MAGIC:
        return None
    at, left, counted = len(SSH_MAGIC), 3, False
    while left:
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at, left = at + 4 + n, left - 1
        if not left and not counted:
            left, at, counted = int.from_bytes(data[at:at + 4], "big") + 1, at + 4, True
            if left > MOST_PARTS:
                return None
    return at if at <= len(data) else None


def is_ssh(data) -> bool:
    return ssh_length(data) == len(data)


class Base64:
    """The bytes of ``text[start:end]``, base64 in either alphabet without its padding, decoded only where they are read.

    A key is confirmed from its few headers, so a run of any length costs no more than its places where a key may begin.
    """

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start, self.end = text, start, end

    def __len__(self) -> int:
        return (self.end - self.start) * 3 // 4

    def __getitem__(self, at):
        lo, hi = (at.start or 0, min(at.stop, len(self))) if isinstance(at, slice) else (at, at + 1)
        if hi <= lo:
            return b""
        first = lo // 3
        quads = self.text[self.start + 4 * first:min(self.start + 4 * -(-hi // 3), self.end)]
        data = base64.b64decode(quads.replace("-", "+").replace("_", "/") + "=" * (-len(quads) % 4))[lo - 3 * first:hi - 3 * first]
        return data if isinstance(at, slice) else data[0]


def decoded(text: str, start: int, end: int) -> list[bytes | Base64]:
    """What ``text[start:end]``, without padding, may stand for: hex, and base64 in either alphabet."""
    out, size = [], end - start
    if size % 2 == 0 and NOT_HEX.search(text, start, end) is None:
        out.append(bytes.fromhex(text[start:end]))
    if size % 4 != 1:
        out.append(Base64(text, start, end))
    return out


def glued(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Parts of the run, set off by signs that base64 has too, that may stand for a key: (start, end).

    A key's own lengths tell where it ends; a sign or the end of the run must follow.
    """
    found = [m.span() for m in PIECE.finditer(text, start, end)]
    for m in BEGINS.finditer(text, start, end):
        at = m.start()
        data = Base64(text, at, end)
        if text[at] == "M":
            top = _element(data, 0, len(data))
            size = top and top[2]
        else:
            size = ssh_length(data)
        if size:
            stop = at + -(-size * 4 // 3)
            if stop == end or text[stop] in "+/_-":
                found.append((at, stop))
    return [part for part in dict.fromkeys(found) if part != (start, end)]


def key_kinds(text: str, start: int, end: int) -> list[int]:
    """Kinds of key that ``text[start:end]`` stands for."""
    return [3 if key else 4 for data in decoded(text, start, end) if (key := is_key(data)) or is_ssh(data)]


def _json(part: str) -> dict | None:
    try:
        x = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return x if isinstance(x, dict) else None


def is_signed_token(candidate: str) -> bool:
    head, payload, _ = candidate.split(".")
    header = _json(head)
    return header is not None and isinstance(header.get("alg"), str) and _json(payload) is not None


def confirmed_spans(text: str) -> list[Span]:
    found = []
    for m in TOKEN.finditer(text):
        if is_signed_token(m[0]):
            found.append((m.start(), 5, m.end()))
    for m in CANDIDATE.finditer(text):
        end = m.start() + len(m[0].rstrip("="))
        whole = [(m.start(), kind, m.end()) for kind in key_kinds(text, m.start(), end)]
        found += whole or [(s, kind, m.end() if e == end else e) for s, e in glued(text, m.start(), end) for kind in key_kinds(text, s, e)]
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            body = LINE_ENDS.sub("", m[2]).rstrip("=")
            found += [] if "=" in body else [(m.start(), kind, m.end()) for kind in key_kinds(body, 0, len(body))]
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(set(spans)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, for every document."""
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base, more = base_spans(text), confirmed_spans(text)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((doc_id, *counts, C.sha(listed(base).encode()), listed(base + more), len(set(more))))
            if rows:
                yield C.batch(_OUT, **dict(zip(_OUT.names, zip(*rows))))

    return C.map_arrow(docs.select(F.col(id_col).cast("long"), C.text_of(text_col)), run, OUT_SCHEMA)


def redacted(text: str, mark: str = "[secret]") -> str:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    out, at, end = [], 0, 0
    for s, _, e in sorted(base_spans(text) + confirmed_spans(text)):
        if s >= end:
            out += [text[at:s], mark]
        at = end = max(end, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The same rows with secrets replaced, and their number of characters, where there is such a column; a null text
    stays null."""
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = [None if t is None else redacted(t) for t in b.column(place).to_pylist()]
            yield b.set_column(place, b.schema.field(place), pa.array(texts, type=b.schema.field(place).type))

    out = C.map_arrow(docs, run, docs.schema)
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.coalesce(F.length(text_col).cast(kind), F.col(chars_col)))
    return out
