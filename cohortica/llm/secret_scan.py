"""Secrets in texts: fixed patterns, and encoded keys and signed tokens confirmed by parsing them."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import slices

KINDS = ("assign", "access", "hex", "pem", "jwt", "b64key", "hexkey")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
# A run that begins inside a longer run is part of it; so looking behind gives the maximal runs.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
# A line break, real or escaped (once or more), with quotes, commas or a plus and marks of quoting around it.
BREAK = re.compile(r"""(?:["'][ \t]*+[+,.]?)?[ \t]*+(?:\r?\n|\r|(?:\\++r)?\\++n)[ \t]*+[#>|*]?[ \t]*+["']?""")
PEM = re.compile(
    r"""-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:\s|\\+[nr]|["'+,#>|*])*+)((?:[A-Za-z][A-Za-z-]*: (?:(?!\\+n)[^\n])*(?:\n|\\+n))*)"""
    r"""((?:[A-Za-z0-9+/=\s"',.#>|*]|\\+[nr/])++)-----END \1-----""")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# Runs of base64 that go on over line breaks, and where a key can begin in them: a sequence or the magic text of OpenSSH.
B64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}+(?:" + BREAK.pattern + r"[A-Za-z0-9+/]++)*+")
BEGIN = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjE")
HEXKEY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
OPENSSH = b"openssh-key-v1\0"
# Letters that each text with "PRIVATE KEY" in it has in base64, by its place among three bytes.
ARMOUR = [base64.b64encode(b"\0" * k + b"PRIVATE KEY").decode()[(8 * k + 5) // 6:8 * (k + 11) // 6] for k in range(3)]


class Decoded:
    """The first ``size`` bytes that base64 letters from ``at`` on stand for, decoded where they are read."""

    def __init__(self, run: str, at: int, size: int):
        self.run, self.at, self.size = run, at, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, key):
        start, stop, _ = key.indices(self.size) if isinstance(key, slice) else (key, key + 1, 1)
        first = self.at + start // 3 * 4
        letters = self.run[first:self.at - (-stop // 3) * 4]
        found = base64.b64decode(letters + "A" * (-len(letters) % 4))[start % 3:start % 3 + max(0, stop - start)]
        return found if isinstance(key, slice) else found[0]


# Values on one level of a private key: nine integers and a few more at most.
MOST_ITEMS = 64


def der_items(data, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[start:end]`` exactly; None if lengths do not nest, or if there are
    more values than any key has."""
    items, at = [], start
    while at < end:
        if len(items) == MOST_ITEMS:
            return None
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


def is_der_key(data) -> bool:
    """A sequence over all of ``data`` in the shape of a private key: RSA (nine integers or more after the version),
    EC (version 1, octets), PKCS 8 (version, algorithm sequence, octets) or its encrypted form (sequence, octets)."""
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(data, outer[0][1], outer[0][2])
    if not items:
        return False
    tags = [t for t, _, _ in items]
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:
        return _algorithm(data, items[0])
    if tags[0] != 0x02 or items[0][2] - items[0][1] != 1 or data[items[0][1]] > 2:
        return False
    if len(tags) >= 6 and all(t == 0x02 for t in tags[1:6]):
        return True
    if tags[1:3] == [0x30, 0x04]:
        return _algorithm(data, items[1])
    return len(tags) >= 2 and tags[1] == 0x04 and data[items[0][1]] == 1 and items[1][2] - items[1][1] >= 16


def _algorithm(data, item: tuple[int, int, int]) -> bool:
    inner = der_items(data, item[1], item[2])
    return bool(inner) and inner[0][0] == 0x06


def ssh_end(data) -> int | None:
    """The magic text, then cipher, kdf and kdf options with their lengths, a number of keys, and that many public keys and a
    private part: where that ends, None in another shape."""
    if data[:len(OPENSSH)] != OPENSSH:
        return None
    at = len(OPENSSH)
    for _ in range(3):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    if at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at if at <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_end(data) is not None


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_ssh_key(data)


def decode64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    if url:
        text = text.translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def pem_spans(text: str) -> list[tuple[int, int]]:
    """Armoured private keys, with real or escaped line breaks."""
    found = []
    for m in PEM.finditer(text):
        data = decode64("".join(BREAK.sub("", m[4]).replace("\\/", "/").replace('"', "").replace("'", "").split()))
        if data and (m[3] and len(data) >= 16 or is_key(data)):
            found.append((m.start(), m.end()))
    return found


def key_spans(run: str) -> list[tuple[int, int]]:
    """Private keys in a run of base64 without breaks, wherever they begin and end in it. Of each possible beginning only
    the lengths are decoded, so the work grows with the run."""
    found, done = [], 0
    for m in BEGIN.finditer(run):
        at = m.start()
        if at < done:
            continue
        size = None
        if run[at] == "M":
            head = base64.b64decode(run[at:at + 12].ljust(12, "A"))
            width = head[1] & 0x7F if head[1] & 0x80 else 0
            # A version or a sequence comes first.
            if width <= 4 and head[2 + width] in (0x02, 0x30):
                size = 2 + width + (int.from_bytes(head[2:2 + width], "big") if width else head[1])
                letters = -(-size * 4 // 3)
                if size < 30 or at + letters > len(run) or not is_der_key(Decoded(run, at, size)):
                    size = None
        else:
            size = ssh_end(Decoded(run, at, (len(run) - at) * 3 // 4))
        if size:
            done = at - (-size * 4 // 3)
            found.append((at, done))
    if any(a in run for a in ARMOUR):
        for skip in range(4):  # glued letters before it shift what is decoded
            whole = base64.b64decode(run[skip:] + "A" * (-len(run[skip:]) % 4)).decode("latin-1")
            found += [(skip + a * 4 // 3, min(len(run), skip - (-b * 4 // 3))) for a, b in pem_spans(whole)]
    return found


def encoded_keys(text: str) -> list[tuple[int, int]]:
    """Private keys in base64, alone or within longer runs, on one line or several; padding belongs to them."""
    found = []
    for m in B64.finditer(text):
        if m.end() - m.start() < 40:
            continue
        start, pieces = m.start(), []
        for gap in BREAK.finditer(m[0]):
            pieces.append((start, m.start() + gap.start()))
            start = m.start() + gap.end()
        pieces.append((start, m.end()))
        spans = key_spans("".join(text[a:b] for a, b in pieces))
        if not spans:
            continue
        places = [k for a, b in pieces for k in range(a, b)]
        for a, b in spans:
            end = places[b - 1] + 1
            if b == len(places):
                end += len(text[end:end + 2]) - len(text[end:end + 2].lstrip("="))
            found.append((places[a], end))
    return found


def is_signed_token(text: str) -> bool:
    """Header and payload decode to JSON objects, the header names an algorithm; signed unless that is none."""
    header, payload, signature = text.split(".")
    try:
        head, body = (json.loads(decode64(x, url=True) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return head["alg"].lower() == "none" or bool(decode64(signature, url=True))


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) in code points, sorted. The first three kinds need no confirmation."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    armoured = pem_spans(text) if "PRIVATE KEY-----" in text else []
    found += [(a, 3, b) for a, b in armoured]
    if "eyJ" in text:
        found += [(m.start(), 4, m.end()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    for a, b in encoded_keys(text):
        # What stands on several lines of an armoured key is that key.
        if not (BREAK.search(text, a, b) and any(x <= a and b <= y for x, y in armoured)):
            found.append((a, 5, b))
    for m in HEXKEY.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            found.append((m.start(), 6, m.end()))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, mask: str = "[secret]") -> str:
    """``text`` with each stretch covered by spans replaced by ``mask``."""
    out, at, spans = [], 0, find_spans(text)
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets in every whole text, one row per input row.

    Columns: id, n_assign, n_access, n_hex, n_confirmed (spans that decoding and parsing confirmed), base_sha256
    (over the first three kinds) and spans (``kind:start:end`` by start, then kind). A null text counts as empty; texts
    without secrets have zero counts and empty spans. Other columns are not read."""

    def find(batches):
        import pyarrow as pa

        for part in slices(batches):
            rows = []
            for text in part.column(1).to_pylist():
                spans = find_spans(text or "")
                n = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
                base = joined([s for s in spans if s[1] < 3])
                rows.append((*n, len(spans) - sum(n), hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]], names=names)

    names = ["id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"]
    ids = F.col(f"`{id_col}`").cast("string").alias("id")
    kind = dict(df.dtypes)[id_col]
    found = df.select(ids, F.col(f"`{text_col}`").alias("text")).mapInArrow(
        find, "id string, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string")
    return found.select(F.col("id").cast(kind).alias(id_col), *names[1:])


def redacted(df: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """All columns of ``df`` with secrets in ``text_col`` masked; null texts stay null."""
    at, names = df.columns.index(text_col), df.columns

    def mask_all(batches):
        import pyarrow as pa

        for part in slices(batches):
            texts = pa.array([None if t is None else redact(t, mask) for t in part.column(at).to_pylist()], part.schema.field(at).type)
            columns = [texts if k == at else c for k, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    # Columns travel by place, so any names may stand beside the text.
    plain = [f"c{k}" for k in range(len(names))]
    renamed = df.toDF(*plain)
    return renamed.mapInArrow(mask_all, renamed.schema).toDF(*names)
