"""Secret scans with structural confirmation.

Base kinds are plain patterns (``assign``, ``access``, ``hex``).  The others
are reported only if they parse: candidates in base64 or hex are decoded and
must be a DER private key whose nested lengths all add up and whose numbers
have a key's sizes, an OpenSSH private key container whose inner lengths do, a
PGP block whose packets and checksum do, or a signed token whose header and
payload decode to JSON with an algorithm.  A wrapped key counts if the key
inside parses, an encrypted one if it names a password cipher.  A PEM block may
itself be in base64.  A random base64 or hex run, a digest or a row of numbers
is not reported by these kinds.

Base64 may be wrapped: line breaks, also escaped ones (a backslash and n or
r), with blanks and quote marks around them, are taken out before decoding.  The
key's own lengths tell how many lines belong to it.  Spans are places in the
original text.

Very long texts take time in proportion to their length: a wrapped run is
walked once, and a header that claims more than ``MAX_KEY`` bytes, or more than
its run holds, is refused without reading on.  Null and empty texts hold nothing.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices

#: Kinds in the order in which they are listed at equal starts.
KINDS = ("assign", "access", "hex", "signed_token", "pem_key", "der_key_base64", "der_key_hex",
         "ssh_key_base64", "pem_key_base64", "pgp_key")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
PGP = re.compile(r"-----BEGIN PGP PRIVATE KEY BLOCK-----((?:[^-]++|-(?!----))*+)-----END PGP PRIVATE KEY BLOCK-----")
PEM_HEADER = re.compile(r"\s*[A-Za-z][A-Za-z0-9-]*:")
DEK_INFO = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,[0-9A-Fa-f]{16,32}\s*$")
DER64 = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))M[A-Za-z0-9+/]{15,}")
DERURL64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-Za-z0-9_-]{39,}(?![A-Za-z0-9+/_-])")
DERHEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{38,}")
#: Bytes set apart by colons, also over lines, as key dumps have them.
DERCOLON = re.compile(r"(?<![0-9A-Fa-f:])30(?::\s{0,64}[0-9A-Fa-f]{2}){19,}(?![0-9A-Fa-f])")
PEM64 = re.compile(r"LS0tLS1CRUdJTi[A-Za-z0-9+/]+")     # five hyphens and BEGIN
#: What ends the search for a block's end mark: bytes that are no text, or another block's beginning.
UNFIT64 = re.compile(r"[^\t\r\n\x20-\x7e]|-----BEGIN")
SSH64 = re.compile(r"b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/]*")
LEAST64 = 40                                              # base64 characters of a key
MAX_KEY = 1 << 16                                         # bytes of an encoded key (RSA of 65,536 bits has 37,000)
LINE64 = re.compile(r"[A-Za-z0-9+/]+")
NEWLINE = re.compile(r"(?<!\\)\\+[nr]|[\r\n]")
#: Between two lines of wrapped base64: a line break, real or escaped, with blanks and marks of string literals.
BREAK64 = re.compile(r"""[ \t"',]*+(?:\\++[nr]|[\r\n])(?:\\[nr]|[\s"'\\]|\+(?=[\s"']))*+""")
PAD64 = re.compile(r"={0,2}")
SSH_MAGIC = b"openssh-key-v1\0"
#: Fixed values, object identifiers in DER: keys of RSA (two), DSA, EC, DH; the four Edwards and Montgomery curves.
OID_RSA = (bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a864886f70d01010a"))
OID_DSA = bytes.fromhex("2a8648ce380401")
OID_EC = bytes.fromhex("2a8648ce3d0201")
OID_DH = bytes.fromhex("2a864886f70d010301")
OID_CURVES = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56,
              bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
#: What the identifiers of password ciphers begin with (PKCS #5 and #12).
OID_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def unbase64(text: str, url_safe: bool = False) -> bytes | None:
    """Strict decoding; padding may be missing."""
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url_safe else None,
                                validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of each element of a DER string, or None if the lengths don't add up."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 0 < k <= 4 or at + k > len(data) or data[at] == 0:
                return None
            n = int.from_bytes(data[at:at + k], "big")
            at += k
            if n < 0x80:
                return None
        if at + n > len(data):
            return None
        items.append((tag, data[at:at + n]))
        at += n
    return items


def numbers(items: list[tuple[int, bytes]]) -> list[int] | None:
    """The values, if all are positive integers or zero."""
    if any(tag != 0x02 or not body or body[0] & 0x80 for tag, body in items):
        return None
    return [int.from_bytes(body, "big") for _, body in items]


def is_rsa(items: list[tuple[int, bytes]]) -> bool:
    """Version, modulus, exponents, primes of half its size, and the remainders that go with them."""
    values = numbers(items[:9])
    if len(items) not in (9, 10) or values is None or (len(items) == 10 and items[9][0] != 0x30):
        return False
    version, n, e, d, p, q, dp, dq, inverse = values
    size, halves = n.bit_length(), (p.bit_length(), q.bit_length())
    return (version in (0, 1) and size >= 384 and 1 < e < n and 1 < d.bit_length() <= size
            and min(halves) * 4 >= size and (len(items) == 10 or abs(sum(halves) - size) <= 8)
            and 0 < dp.bit_length() <= halves[0] and 0 < dq.bit_length() <= halves[1]
            and 0 < inverse.bit_length() <= max(halves))


def is_dsa(items: list[tuple[int, bytes]]) -> bool:
    """Version 0, prime, order of the group, base, public and private number."""
    values = numbers(items)
    if len(items) != 6 or values is None:
        return False
    version, p, q, g, public, private = values
    return (version == 0 and p.bit_length() >= 512 and 160 <= q.bit_length() <= 512 and q < p
            and 1 < g < p and 1 < public < p and 0 < private < q)


def is_ec(items: list[tuple[int, bytes]]) -> bool:
    """Version 1, a number of a curve's size, and at most the curve and the public point in tagged fields."""
    if len(items) < 2 or items[0] != (0x02, b"\1") or items[1][0] != 0x04 or not 14 <= len(items[1][1]) <= 72:
        return False
    inner = {0xA0: (0x06, 0x30), 0xA1: (0x03,)}
    rest = [(tag, der_items(body)) for tag, body in items[2:]]
    return ([tag for tag, _ in rest] in ([], [0xA0], [0xA1], [0xA0, 0xA1])
            and all(body and len(body) == 1 and body[0][0] in inner[tag] for tag, body in rest))


def is_wrapped(items: list[tuple[int, bytes]]) -> bool:
    """Version, method and a key of that method (of any known kind, if the method is another)."""
    method, body = der_items(items[1][1]), der_items(items[2][1])
    if (items[0][1] not in (b"\0", b"\1") or not method or method[0][0] != 0x06 or not body or len(body) != 1
            or any(tag not in (0xA0, 0x81, 0xA1) for tag, _ in items[3:])):
        return False
    oid, (tag, data) = method[0][1], body[0]
    if oid in OID_CURVES:
        return tag == 0x04 and len(data) == OID_CURVES[oid]
    if oid in (OID_DSA, OID_DH):
        return tag == 0x02 and len(data) >= 16 and numbers(body) is not None
    parts = der_items(data) if tag == 0x30 else None
    if not parts:
        return False
    return (oid not in (OID_EC,) and is_rsa(parts)) or (oid not in OID_RSA and is_ec(parts))


def is_encrypted(items: list[tuple[int, bytes]]) -> bool:
    """A password cipher with its parameters, and whole cipher blocks."""
    method = der_items(items[0][1])
    return (bool(method) and len(method) == 2 and method[0][0] == 0x06 and method[0][1].startswith(OID_PASSWORD)
            and method[1][0] == 0x30 and len(der_items(method[1][1]) or []) == 2
            and len(items[1][1]) >= 32 and len(items[1][1]) % 8 == 0)


def is_der_key(data: bytes | None) -> bool:
    """A private key in DER: RSA or DSA numbers, an EC key, or a wrapped or encrypted key."""
    outer = der_items(data) if data and len(data) <= MAX_KEY else None
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(outer[0][1])
    if not items or len(items) < 2:
        return False
    tags = [t for t, _ in items]
    if tags == [0x30, 0x04]:
        return is_encrypted(items)
    if tags[0] != 0x02 or len(items[0][1]) != 1:                          # a version comes first
        return False
    if tags[1:3] == [0x30, 0x04]:
        return is_wrapped(items)
    return is_ec(items) or is_dsa(items) or is_rsa(items)


def is_ssh_key(data: bytes | None) -> bool:
    """An OpenSSH private key container whose length-prefixed fields end with it."""
    if not data or not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n:at]

    if any(field() is None for _ in range(3)):                            # cipher, derivation, options
        return False
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 0 < keys <= 16:
        return False
    return all(field() is not None for _ in range(keys + 1)) and at == len(data)


class Run:
    """The lines of a wrapped base64 run, found as far as they are asked for and kept for later starts in it."""

    def __init__(self, text: str, at: int):
        self.text, self.more = text, True
        self.starts, self.ends, self.before = array("q"), array("q"), array("q")   # before: characters up to the line
        self._line(at)

    def _line(self, at: int) -> None:
        line = LINE64.match(self.text, at)
        if not line:
            self.more = False
            return
        self.before.append(self.before[-1] + self.ends[-1] - self.starts[-1] if self.ends else 0)
        self.starts.append(line.start())
        self.ends.append(line.end())

    def _next(self) -> bool:
        gap = self.more and BREAK64.match(self.text, self.ends[-1])
        if gap:
            self._line(gap.end())
        else:
            self.more = False
        return self.more

    def holds(self, at: int) -> bool:
        """Whether a line found so far, or the next one, has the place."""
        if at >= self.ends[-1] and self.more:
            self._next()
        line = bisect_right(self.starts, at) - 1
        return line >= 0 and at < self.ends[line]

    def _reach(self, at: int, n: int) -> tuple[int, int, int]:
        """The line of a place, that of the n-th character from there (or the last), and the characters up to that one."""
        line = bisect_right(self.starts, at) - 1
        goal = self.before[line] + at - self.starts[line] + n
        while self.before[-1] + self.ends[-1] - self.starts[-1] < goal and self._next():
            pass
        return line, max(line, bisect_left(self.before, goal) - 1), goal

    def first(self, at: int, n: int) -> str:
        """The first n characters from a place in the run; fewer if it ends."""
        line, last, goal = self._reach(at, n)
        end = min(self.ends[last], self.starts[last] + goal - self.before[last])
        return "".join(self.text[max(at, self.starts[i]):min(end, self.ends[i])] for i in range(line, last + 1))

    def line_end(self, at: int, n: int) -> int | None:
        """The place behind n characters from a place in the run, if a line ends there."""
        _, last, goal = self._reach(at, n)
        return self.ends[last] if self.before[last] + self.ends[last] - self.starts[last] == goal else None


def key64(run: Run, at: int, size: Callable[[bytes], int | None], confirm: Callable[[bytes], bool],
          exact: bool) -> int | None:
    """The end of the wrapped base64 key at ``at``, or None.

    ``size`` tells the bytes of the key from its first bytes (None: no key), all
    of them (``exact``) or how many it must see to tell.  The key must end where
    a line ends.
    """
    n, wanted, data = LEAST64, 0, None
    while data is None or wanted > len(data):
        chars = run.first(at, n)
        data = unbase64(chars)
        wanted = size(data) if data and len(chars) >= LEAST64 else None
        if wanted is None or wanted > MAX_KEY or wanted > len(data) and len(chars) < n:
            return None
        if exact and run.line_end(at, -(-wanted * 4 // 3)) is None:
            return None
        n = -(-wanted // 3) * 4
    n = -(-wanted * 4 // 3)
    end = run.line_end(at, n) if n >= LEAST64 else None
    if end is None or not confirm(data[:wanted]):
        return None
    return PAD64.match(run.text, end).end()


def block64(run: Run, at: int) -> int | None:
    """The end of the base64 of a PEM key block that begins at ``at``, or None.

    Decoding goes on only while it gives printable text up to the block's end mark.
    """
    n = 256
    while True:
        chars = run.first(at, n)
        data = unbase64(chars) or unbase64(chars[:len(chars) // 4 * 4]) or b""
        text = data.decode("latin-1")                         # lines that follow the block may be in the run, too
        block = PEM.match(text)
        if block:
            least = -(-block.end() * 4 // 3)
            for n in range(least, least + 5) if is_pem_key(block[2]) else ():    # at most a line break behind it
                end = run.line_end(at, n)
                if end is not None and not text[block.end():n * 3 // 4].strip():
                    return PAD64.match(run.text, end).end()
            return None
        if len(chars) < n or n > 8 * MAX_KEY or UNFIT64.search(text, 5):
            return None
        n *= 2


def der_size(data: bytes) -> int | None:
    """Bytes of the first element of a DER string, by its header."""
    if data is None or len(data) < 12 or data[0] != 0x30:
        return None
    k = data[1] & 0x7F if data[1] & 0x80 else 0
    if k > 4 or data[1] == 0x80 or data[2 + k] not in (0x02, 0x30):      # a version or a method comes first
        return None
    return 2 + k + (int.from_bytes(data[2:2 + k], "big") if k else data[1])


def ssh_size(data: bytes) -> int | None:
    """Bytes of an OpenSSH container, as far as its fields tell: at least one byte more where they are cut."""
    at, keys = len(SSH_MAGIC), None
    left = 3
    while left or keys is None:
        if at + 4 > len(data):
            return max(at + 4, len(data) + 1)
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if left:
            at, left = at + n, left - 1
        elif not 0 < n <= 16:
            return None
        else:
            keys = left = n + 1
    return at


def crc24(data: bytes) -> int:
    """The checksum of PGP armour (fixed values: start and polynomial)."""
    crc = 0xB704CE
    for byte in data:
        crc ^= byte << 16
        for _ in range(8):
            crc = crc << 1 ^ (0x1864CFB if crc & 0x800000 else 0)
    return crc & 0xFFFFFF


def is_pgp_key(body: str) -> bool:
    """Packets whose lengths add up, a secret key first; a checksum line must fit."""
    if len(body) > 4 * MAX_KEY:
        return False
    lines = [x.strip() for x in NEWLINE.split(body)]
    while lines and (not lines[0] or PEM_HEADER.match(lines[0])):
        lines.pop(0)
    text = "".join(lines)
    text, mark, check = text.rpartition("=") if re.search(r"=[A-Za-z0-9+/]{4}$", text) else (text, "", "")
    data = unbase64(text)
    if not data or mark and crc24(data).to_bytes(3, "big") != unbase64(check):
        return False
    at, tags = 0, []
    while at < len(data):
        head, at = data[at], at + 1
        if not head & 0x80 or at >= len(data):
            return False
        if head & 0x40:                                       # the newer form of lengths
            tags.append(head & 0x3F)
            first = data[at]
            k = 1 if first < 192 else 2 if first < 224 else 5
            if 224 <= first < 255:
                return False
            n = (first if k == 1 else (first - 192 << 8) + 192 + int.from_bytes(data[at + 1:at + 2], "big") if k == 2
                 else int.from_bytes(data[at + 1:at + 5], "big"))
        else:
            tags.append(head >> 2 & 0xF)
            if head & 3 == 3:
                return False
            k = 1 << (head & 3)
            n = int.from_bytes(data[at:at + k], "big")
        at += k + n
    return at == len(data) and tags[0] == 5


def pem_data(body: str) -> tuple[bytes | None, bool]:
    """What a PEM block holds, and whether its header lines name a cipher (so it holds no plain key)."""
    lines = NEWLINE.split(re.sub(r"(?<!\\)(?:\\*+\r\n|\\++r\\++n)", "\n", body))
    headers = [i for i, x in enumerate(lines) if PEM_HEADER.match(x.lstrip(" \t\"'"))]
    ciphered = any(DEK_INFO.search(lines[i].rstrip(" \t\"',+\\")) for i in headers)
    if headers:
        blank = [i for i, x in enumerate(lines) if i > headers[-1] and not x.strip(" \t\"',+\\")]
        lines = lines[blank[0]:] if blank else lines[headers[-1] + 1:]
    return unbase64("".join(re.sub(r"""[\s"',\\]+|(?<=["'\s])\+(?=\s*$)|^\s*\+(?=\s*["'])""", "", x)
                            for x in lines)), ciphered


def is_pem_key(body: str) -> bool:
    """A key in DER or an OpenSSH key; with a cipher's header lines, whole cipher blocks."""
    data, ciphered = pem_data(body) if len(body) <= 4 * MAX_KEY else (None, False)
    if ciphered:
        return bool(data) and len(data) >= 16 and len(data) % 8 == 0
    return is_der_key(data) or is_ssh_key(data)


def wrapped_keys(kind: str, start: re.Pattern, text: str,
                 ends: Callable[[Run, int], int | None]) -> list[tuple[str, int, int, int]]:
    """Spans of the base64 keys that begin where ``start`` matches."""
    out, run = [], None
    for m in start.finditer(text):
        if out and m.start() < out[-1][2] or kind == "der_key_base64" and not plausible(m.group()[:16]):
            continue
        if run is None or not run.holds(m.start()):
            run = Run(text, m.start())
        end = ends(run, m.start())
        if end is not None:
            out.append((kind, m.start(), end, m.start()))
    return out


def plausible(chars: str) -> bool:
    """Whether the first base64 characters of a DER string have a key's header."""
    size = der_size(unbase64(chars))
    return size is not None and size <= MAX_KEY


def is_signed_token(token: str) -> bool:
    """Header and payload are JSON objects, and the header names an algorithm."""
    parts = token.split(".")
    for part, needs in zip(parts, ("alg", None)):
        raw = unbase64(part, url_safe=True)
        try:
            value = json.loads(raw) if raw else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or needs and not isinstance(value.get(needs), str):
            return False
    return True


def find(text: str | None) -> list[tuple[str, int, int, int]]:
    """Spans ``(kind, start, end, value start)`` by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    if "ey" in text or "ew" in text:
        out += [("signed_token", *m.span(), m.start()) for m in TOKEN.finditer(text)
                if is_signed_token(m.group())]
    if "PRIVATE KEY-----" in text:
        out += [("pem_key", *m.span(), m.start()) for m in PEM.finditer(text) if is_pem_key(m.group(2))]
    if "PGP PRIVATE KEY BLOCK-----" in text:
        out += [("pgp_key", *m.span(), m.start()) for m in PGP.finditer(text) if is_pgp_key(m.group(1))]
    out += wrapped_keys("der_key_base64", DER64, text, lambda run, at: key64(run, at, der_size, is_der_key, True))
    out += [("der_key_base64", *m.span(), m.start()) for m in DERURL64.finditer(text)
            if ("-" in m.group() or "_" in m.group()) and is_der_key(unbase64(m.group(), url_safe=True))]
    for pattern in (DERHEX, DERCOLON):
        for m in pattern.finditer(text):
            digits = re.sub(r"[:\s]+", "", m.group()) if pattern is DERCOLON else m.group()
            if len(digits) % 2 == 0 and len(digits) <= 2 * MAX_KEY and is_der_key(bytes.fromhex(digits)):
                out.append(("der_key_hex", *m.span(), m.start()))
    if "b3BlbnNzaC1rZXktdjEA" in text:
        out += wrapped_keys("ssh_key_base64", SSH64, text, lambda run, at: key64(run, at, ssh_size, is_ssh_key, False))
    if "LS0tLS1CRUdJTi" in text:
        out += wrapped_keys("pem_key_base64", PEM64, text, block64)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None, spans: list[tuple[str, int, int, int]]) -> str | None:
    """The text with every secret value replaced by its kind; overlaps become one."""
    if not spans:
        return text
    merged: list[list] = []
    for kind, _, end, at in sorted(spans, key=lambda s: (s[3], KINDS.index(s[0]))):
        if merged and at < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, at, end])
    out, last = [], 0
    for kind, at, end in merged:
        out += [text[last:at], f"[{kind}]"]
        last = end
    return "".join([*out, text[last:]])


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                           ("value_start", pa.int32())]))


def _scan(position: int, with_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(position).to_pylist()
            found = [find(t) for t in texts]
            spans = pa.array([[dict(zip(("kind", "start", "end", "value_start"), s)) for s in f]
                              for f in found], SPAN)
            cols, names = list(part.columns), list(part.schema.names)
            if with_text:
                cols[position] = pa.array([redacted(t, f) for t, f in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_arrays([*cols, spans], names=[*names, "secrets"])
    return scan


SPANS = "secrets array<struct<kind:string,start:int,end:int,value_start:int>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``secrets`` (kind, start, end, value start) of every row.

    Null and empty texts have an empty list.  Repeated or null ids keep a row each.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return docs.mapInArrow(_scan(1, False), f"`{id_col}` {docs.dtypes[0][1]}, `{text_col}` string, {SPANS}"
                           ).select(id_col, "secrets")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret value in ``text_col`` replaced by ``[kind]``, all rows kept.

    ``secrets`` lists what was found, with places in the original text; a
    column of that name is replaced.
    """
    docs = docs.drop("secrets")
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(_scan(docs.columns.index(text_col), True), f"{schema}, {SPANS}")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined, in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
