"""Secrets in texts: pattern spans, and spans confirmed by their structure.

Three patterns give the base spans. Further candidates (base64 or hex letters,
dotted tokens, armoured blocks) are decoded and reported only if what they hold parses
as what it claims to be: a token header that is JSON with an algorithm, or a private
key whose nested lengths fill each other exactly. Keys may go on over white space and
over line ends that are spelt as escapes (``\\n`` as letters): a bare key's own lengths say
how many letters it has. Letters may also stand for an armoured key or a token in letters: these are decoded once more.

The work is linear in a text: letters are gathered once, and of a candidate only its lengths are read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs of 24 letters or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "openssh")

_WORDS = ("password", "passwd", "secret", "token", "api")
# White space, or a line end or tab spelt as an escape, also one that was escaped again.
_GAP = r"(?:\s|\\+[nrt])"
_AFTER_ESCAPE = r"(?<=\\[nrt])"
# A JSON object begins with a brace or white space: C, D, I or e in base64. Overlapping candidates are all judged.
_DOTTED = re.compile(r"(?:(?<![A-Za-z0-9_-])|" + _AFTER_ESCAPE
                     + r")(?=([CDIe][A-Za-z0-9_-]{9,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+))")
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]++|\\++[nrt])++)-----END \1-----")
_GAPS = re.compile(_GAP + "+")
# Where a bare key can begin (0x30, or the name of OpenSSH keys), its letters with gaps, bits of a letter, and least letters.
_BASE64 = (re.compile(r"(?:(?<![A-Za-z0-9+/_-])|" + _AFTER_ESCAPE + r")(?:M[A-P]|b3Bl)"),
           re.compile(r"([A-Za-z0-9+/_-]++)|" + _GAP + "++"), 6, 40)
_HEX_ANY = (re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70)"), re.compile(r"([0-9A-Fa-f]++)|" + _GAP + "++"), 4, 48)
_PADDING = re.compile(r"={1,2}|(?:\r?\n|(?:\\+r)?\\+n)[ \t]*(={1,2})")
# The armour of a key, and the head of a token, as base64 or hex letters.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:(?:LS0tLS1CRUdJTi|ZXlK)[A-Za-z0-9+/_-]*+={0,2}"
                      r"|(?:2[dD]2[dD]2[dD]2[dD]2[dD]424547494[eE]|65794[aA])[0-9A-Fa-f]*+(?![A-Za-z0-9+/_-]))")
_OPENSSH = b"openssh-key-v1\x00"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the three base kinds, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def from_base64(letters: str) -> bytes | None:
    """Either alphabet, padded or not; null if it is no base64."""
    letters = letters.rstrip("=").replace("-", "+").replace("_", "/")
    if len(letters) % 4 == 1:
        return None
    try:
        return base64.b64decode(letters + "=" * (-len(letters) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


class Letters:
    """The bytes that ``count`` letters from ``first`` on stand for, decoded where they are looked at.

    A key's lengths are read without its contents, so judging a candidate does not take longer the more it claims.
    """

    def __init__(self, letters: str, bits: int, first: int, count: int):
        self.letters, self.bits, self.first, self.size = letters, bits, first, count * bits // 8

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        start, stop, _ = part.indices(self.size)
        if stop <= start:
            return b""
        if self.bits == 4:
            return bytes.fromhex(self.letters[self.first + 2 * start:self.first + 2 * stop])
        data = from_base64(self.letters[self.first + start // 3 * 4:self.first + -(-stop * 4 // 3)]) or b""
        return data[start % 3:][:stop - start]


class Chain:
    """Letters that follow each other over gaps, from a place in a text to where they end."""

    def __init__(self, text: str, at: int, pieces: re.Pattern):
        self.starts, self.before, runs, n = [], [], [], 0
        while m := pieces.match(text, at):
            if m.group(1):
                self.starts.append(at)
                self.before.append(n)
                runs.append(m.group(1))
                n += len(m.group(1))
            at = m.end()
        self.letters, self.end = "".join(runs), at

    def index(self, place: int) -> int:
        run = bisect_right(self.starts, place) - 1
        return self.before[run] + place - self.starts[run]

    def place(self, index: int) -> int:
        run = bisect_right(self.before, index) - 1
        return self.starts[run] + index - self.before[run]


# The most values that the sequence of a private key holds.
KEY_VALUES = 9


def der_items(data, at: int, end: int, most: int = KEY_VALUES) -> list[tuple[int, int, int]] | None:
    """``(tag, start, end)`` of the values that fill ``[at, end)`` exactly; null if lengths do not fit or there are over ``most``."""
    out = []
    while at < end:
        head = data[at:min(at + 6, end)]
        if len(head) < 2 or len(out) == most:
            return None
        tag, size, used = head[0], head[1], 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or 2 + n > len(head):
                return None
            size, used = int.from_bytes(head[2:2 + n], "big"), 2 + n
            if size < 0x80:  # DER takes the shortest form
                return None
        at += used
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_private_key(data) -> bool:
    """Whether the bytes are a DER private key: PKCS#1, PKCS#8 (plain or encrypted), SEC1 or DSA.

    Only the heads of values are read, so the answer takes as long for a key of any size.
    """
    outer = der_items(data, 0, len(data), 1)
    if not outer or outer[0][0] != 0x30:
        return False
    items = der_items(data, *outer[0][1:])
    if not items:
        return False
    tags = [t for t, _, _ in items]
    # A number of over four bytes is neither of the versions.
    _, start, end = items[0]
    number = int.from_bytes(data[start:end], "big") if tags[0] == 0x02 and end - start <= 4 else None
    if number in (0, 1) and tags[1:3] == [0x30, 0x04]:  # PKCS#8: algorithm, key
        inner = der_items(data, *items[1][1:])
        return bool(inner) and inner[0][0] == 0x06
    if number == 1 and tags[1:2] == [0x04]:  # SEC1
        return all(t & 0xE0 == 0xA0 for t in tags[2:])
    if number in (0, 1) and set(tags) == {0x02} and len(tags) in (6, 9):  # DSA, PKCS#1
        return all(b > a for _, a, b in items)
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        inner = der_items(data, *items[0][1:])
        return bool(inner) and inner[0][0] == 0x06
    return False


def der_size(data: bytes) -> int | None:
    """The bytes of the DER sequence that begins here, if its first item can be that of a private key."""
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    if data[0] != 0x30 or head > 6 or data[head] not in (0x02, 0x30):
        return None
    return head + (int.from_bytes(data[2:head], "big") if head > 2 else data[1])


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key: its name, then fields that fill it by their lengths."""
    return openssh_size(data) == len(data)


def openssh_size(data) -> int | None:
    """The bytes of the OpenSSH private key that begins here; null if its fields do not fit."""
    if data[:len(_OPENSSH)] != _OPENSSH:
        return None
    at = len(_OPENSSH)

    def field() -> bool:
        nonlocal at
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        return at <= len(data)

    if not all(field() for _ in range(3)):  # cipher, key derivation, its options
        return None
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    return at if 1 <= count <= 16 and all(field() for _ in range(count + 1)) else None


def is_signed_token(token: str) -> bool:
    """Whether the header and payload of a dotted token are JSON objects and the header names an algorithm."""
    parts = [from_base64(p) for p in token.split(".")]
    try:
        header, payload = json.loads(parts[0]), json.loads(parts[1])
    except (TypeError, ValueError, RecursionError):
        return False
    if not (isinstance(header, dict) and isinstance(payload, dict) and isinstance(header.get("alg"), str)):
        return False
    return parts[2] is not None and (bool(parts[2]) or header["alg"].lower() == "none")


def bare_keys(text: str, start: re.Pattern, pieces: re.Pattern, bits: int, least: int):
    """``(start, kind number, end)`` of keys without armour: as many letters as their lengths say, and no more.

    Letters are gathered once, however many candidates begin among them.
    """
    chain = None
    for m in start.finditer(text):
        at = m.start()
        if chain is None or at >= chain.end:
            chain = Chain(text, at, pieces)
        first = chain.index(at)
        left = len(chain.letters) - first
        if left < least:
            continue
        rest = Letters(chain.letters, bits, first, left)
        head = rest[:len(_OPENSSH)]
        if head[0] == 0x30:
            kind, size = 5, der_size(head)
        elif head == _OPENSSH:
            kind, size = 6, openssh_size(rest)
        else:
            continue
        if size is None:
            continue
        n = -(-8 * size // bits)
        if not least <= n <= left:
            continue
        end = chain.place(first + n - 1) + 1
        if n < left and chain.place(first + n) == end:  # more letters follow at once
            continue
        key = Letters(chain.letters, bits, first, n)
        if is_private_key(key) if kind == 5 else openssh_size(key) == len(key):
            padding = _PADDING.match(text, end) if bits == 6 else None
            if padding and (padding.group(1) is None or len(padding.group(1)) == -n % 4):
                end = padding.end()
            yield at, kind, end


def armoured_keys(text: str) -> list[tuple[int, int, int]]:
    found = []
    if "PRIVATE KEY-----" in text:
        for m in _ARMOUR.finditer(text):
            data = from_base64(_GAPS.sub("", m.group(2)))
            if data and (is_private_key(data) or is_openssh_key(data)):
                found.append((m.start(), 4, m.end()))
    return found


def wrapped(text: str) -> list[tuple[int, int, int]]:
    """Base64 or hex letters that decode to an armoured key or to a signed token, as a cluster's secrets have them: one level."""
    found = []
    for m in _WRAPPED.finditer(text):
        letters = m.group()
        data = bytes.fromhex(letters[:len(letters) // 2 * 2]) if letters[0] in "62" else from_base64(letters)
        inner = (data or b"").decode("latin-1")
        if armoured_keys(inner):
            found.append((m.start(), 4, m.end()))
        elif is_signed_token(inner.strip()):
            found.append((m.start(), 3, m.end()))
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of what decodes to a key or a signed token."""
    found = []
    if "." in text:
        found += [(m.start(1), 3, m.end(1)) for m in _DOTTED.finditer(text) if is_signed_token(m.group(1))]
    armoured = armoured_keys(text)
    found += armoured + wrapped(text)
    begins = [a for a, _, _ in armoured]  # ascending and apart
    for form in (_BASE64, _HEX_ANY):
        for key in bare_keys(text, *form):
            at = bisect_right(begins, key[0]) - 1
            if at < 0 or key[0] >= armoured[at][2]:
                found.append(key)
    return sorted(set(found))


def spelt(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SPANS = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
         "n_confirmed bigint")


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``SPANS`` of every text: spans are ``kind:start:end`` in code points, by start, then kind.

    A null or empty text has none (the digest is that of no text); a null id
    stays null; repeated rows are scanned again; an empty table gives no rows;
    other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = value.as_py() or ""
                base, more = base_spans(whole), confirmed_spans(whole)
                kinds = [k for _, k, _ in base]
                rows.append((key, kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(spelt(base).encode()).hexdigest(), spelt(sorted(base + more)), len(more)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = [f.split()[0] for f in SPANS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)],
                                             names)

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SPANS)


def redacted(text: str) -> str:
    """The text with every maximal run of secret characters replaced by ``[SECRET]``."""
    out, at = [], 0
    reach = None
    for a, _, b in sorted(base_spans(text) + confirmed_spans(text)):
        if reach is not None and a < reach:
            reach = max(reach, b)
            continue
        if reach is not None:
            at = reach
        out += [text[at:a], "[SECRET]"]
        reach = b
    return "".join(out) + text[reach or 0:]


def redact(docs: DataFrame, text: str = "text", flag: str | None = None) -> DataFrame:
    """The rows with the secrets of one text column replaced; null texts stay null, other columns as they are.

    ``flag`` names a further, boolean column: whether the text was changed.
    """

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            before = batch.column(at).to_pylist()
            after = [None if v is None else redacted(v) for v in before]
            out = batch.set_column(at, batch.schema.field(at), pa.array(after, batch.schema.field(at).type))
            if flag is not None:
                changed = pa.array([x != y for x, y in zip(before, after)], pa.bool_())
                out = pa.RecordBatch.from_arrays([*out.columns, changed], [*out.schema.names, flag])
            yield out

    schema = docs.schema if flag is None else StructType([*docs.schema.fields, StructField(flag, BooleanType())])
    return docs.mapInArrow(run, schema)
