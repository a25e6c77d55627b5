"""Streams of bytes to records: bounded inflation, JSON values as they become complete, framed records and their checksums."""

from __future__ import annotations

import codecs
import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from typing import BinaryIO

import numpy as np

#: Compressed bytes read, and bytes unpacked, at a time.
READ_BYTES, UNPACKED_BYTES = 1 << 16, 1 << 20


class Ending:
    """Whether a stream was read to its proper end."""

    proper = False


def inflated(stream: BinaryIO, cap: int | None = None, end: Ending | None = None) -> Iterator[tuple[bytes, int]]:
    """What a stream holds, unpacked if it is gzip, in pieces, each with the bytes of the stream read so far.

    At most ``cap`` bytes of the stream are read.  A gzip stream that breaks
    off or is broken ends with what could be unpacked; several gzip members are
    one text.
    """
    read, unpack = 0, None
    while cap is None or read < cap:
        piece = stream.read(READ_BYTES if cap is None else min(READ_BYTES, cap - read))
        if not piece:
            if end is not None:
                end.proper = unpack is None or unpack.eof
            return
        if not read and piece[:2] == b"\x1f\x8b":
            unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
        read += len(piece)
        if unpack is None:
            yield piece, read
            continue
        while piece:
            if unpack.eof:
                unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
            before = unpack.copy()
            try:
                out = unpack.decompress(piece, UNPACKED_BYTES)
            except zlib.error:
                yield from ((out, read) for out in _until_broken(before, piece) if out)
                return
            if out:
                yield out, read
            piece = unpack.unused_data if unpack.eof else unpack.unconsumed_tail


def _until_broken(unpack: zlib._Decompress, piece: bytes) -> Iterator[bytes]:
    """What a piece holds before the byte at which it is broken."""
    for k in range(len(piece)):
        try:
            yield unpack.decompress(piece[k : k + 1])
        except zlib.error:
            return


class JsonValues:
    """The complete top-level values of a text that comes in pieces: JSON lines, values one after another, or the entries of one array.

    An incomplete value is carried over; as reading it again costs its length,
    that is done only when the text has doubled.  In lines, what is malformed
    goes, up to the next line that starts with an object; in an array, it ends
    the scan, as what follows may lie inside the broken entry.
    """

    _between = re.compile(r"[\s,\[\]]*")
    _object = re.compile(r"\n(?=\{)")
    _number = re.compile(r"\.|[eE][+-]?")
    _words = ("true", "false", "null", "NaN", "Infinity", "-Infinity")

    def __init__(self) -> None:
        self.decoder = json.JSONDecoder()
        self.rest, self.waiting = "", 0
        self.array: bool | None = None
        self.lost = self.ended = False

    def feed(self, text: str, last: bool = False) -> Iterator[str]:
        """Values that are complete now; ``last`` says that the input ends here, and not at a cap."""
        self.rest += text
        if self.ended:
            self.rest = ""
        if self.array is None and (start := self.rest.lstrip()):
            self.array = start[0] == "["
        if not last and len(self.rest) < self.waiting:
            return
        at = 0
        while True:
            if self.lost:
                found = self._object.search(self.rest, at)
                if not found:
                    self.rest = self.rest[-1:]
                    return
                at, self.lost = found.end(), False
            at = self._between.match(self.rest, at).end()
            if at == len(self.rest):
                break
            try:
                _, end = self.decoder.raw_decode(self.rest, at)
            except json.JSONDecodeError as e:
                if self._breaks_off(e):
                    break
                if self.array:
                    self.ended, self.rest = True, ""
                    return
                self.lost = True
                continue
            if end == len(self.rest) and self.rest[at] not in '{"' and not last:
                break  # more digits may follow
            yield self.rest[at:end]
            at = end
        self.rest = self.rest[at:]
        self.waiting = 2 * len(self.rest)

    def _breaks_off(self, e: json.JSONDecodeError) -> bool:
        left = self.rest[e.pos :]
        if e.msg.startswith("Unterminated string") or not left.strip():
            return True
        return any(w.startswith(left) for w in self._words) or bool(self._number.fullmatch(left)) or ("escape" in e.msg and len(left) < 12)


def json_values(pieces: Iterator[bytes], whole: bool = True) -> Iterator[str]:
    """The complete values of UTF-8 in pieces; ``whole`` if the pieces are all there is."""
    decode, values = codecs.getincrementaldecoder("utf-8")("replace"), JsonValues()
    for piece in pieces:
        yield from values.feed(decode.decode(piece))
    yield from values.feed("", last=whole)
    values.waiting = 0
    yield from values.feed("")


def whole_lines(pieces: Iterator[bytes], end: Ending) -> Iterator[str]:
    """Lines of UTF-8 in pieces; a last one without its line end only if the text has its proper ``end`` there."""
    rest: list[bytes] = []
    for piece in pieces:
        *lines, tail = piece.split(b"\n")
        for line in lines:
            yield b"".join([*rest, line]).decode("utf-8", "replace")
            rest = []
        rest.append(tail)
    if end.proper and (left := b"".join(rest)):
        yield left.decode("utf-8", "replace")


# CRC-32C, as framed records use it: fixed polynomial, and a fixed rotation and addend for the stored form.
_POLYNOMIAL, _ROTATE, _ADD = 0x82F63B78, 15, 0xA282EAD8


@cache
def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(_POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


def _through(crc: np.ndarray, columns: np.ndarray) -> np.ndarray:
    table = _table()
    for k in range(columns.shape[1]):
        crc = table[(crc ^ columns[:, k]) & 255] ^ crc >> np.uint32(8)
    return crc


@cache
def _zeros(n: int) -> np.ndarray:
    """What ``n`` (a power of two) zero bytes make of each of the 32 bits of a remainder."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return _through(bits, np.zeros((32, 1), np.uint32)) if n == 1 else _moved(_zeros(n // 2), n // 2)


def _moved(crc: np.ndarray, n: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.where(crc[:, None] >> np.arange(32, dtype=np.uint32) & 1, _zeros(n), 0).astype(np.uint32), axis=1)


def masked_checksums(bodies: list[bytes]) -> np.ndarray:
    """The stored form of the CRC-32C of every body.

    Zero bytes before a text leave a remainder of zero as it is, so all bodies
    get one length, are cut into blocks that go side by side, and the blocks'
    remainders are joined pairwise.
    """
    out = np.empty(len(bodies), np.uint32)
    order = sorted(range(len(bodies)), key=lambda i: len(bodies[i]))
    at = 0
    while at < len(order):
        many = 1
        while at + many < len(order) and many < 4096 and (many + 1) * len(bodies[order[at + many]]) <= 1 << 22:
            many += 1
        part = order[at : at + many]
        longest = max(4, len(bodies[part[-1]]))
        width = 1 << max(0, min(8, (longest - 1).bit_length()))
        blocks = 1 << (-(-longest // width) - 1).bit_length()
        cells = np.zeros((many, blocks * width), np.uint8)
        start = np.zeros(many, np.uint32)
        for k, i in enumerate(part):
            body = np.frombuffer(bodies[i], np.uint8).copy()
            if len(body) >= 4:
                body[:4] ^= 255  # the remainder starts with all bits set
            else:
                start[k] = _through(np.array([0xFFFFFFFF], np.uint32), body[None].astype(np.uint32))[0]
                body[:] = 0
            cells[k, cells.shape[1] - len(body) :] = body
        crc = _through(np.zeros(many * blocks, np.uint32), cells.reshape(many * blocks, width))
        size = width
        while len(crc) > many:
            crc = _moved(crc[0::2], size) ^ crc[1::2]
            size *= 2
        crc = np.where([len(bodies[i]) < 4 for i in part], start, crc).astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
        out[part] = (crc >> np.uint32(_ROTATE) | crc << np.uint32(32 - _ROTATE)) + np.uint32(_ADD)
        at += many
    return out


def framed(bodies: list[bytes]) -> Iterator[bytes]:
    """Records with length and checksums."""
    sizes = [len(b).to_bytes(8, "little") for b in bodies]
    for n, a, body, b in zip(sizes, masked_checksums(sizes), bodies, masked_checksums(bodies), strict=True):
        yield n + int(a).to_bytes(4, "little") + body + int(b).to_bytes(4, "little")


def frame_starts(block: bytes) -> np.ndarray:
    """Where in ``block`` eight bytes are followed by their checksum, as a record's length is."""
    raw = np.frombuffer(block, np.uint8)
    if len(raw) < 12:
        return np.zeros(0, np.int64)
    n = len(raw) - 11
    crc = np.full(n, 0xFFFFFFFF, np.uint32)
    for k in range(8):
        crc = _table()[(crc ^ raw[k : k + n]) & 255] ^ crc >> np.uint32(8)
    crc ^= np.uint32(0xFFFFFFFF)
    masked = (crc >> np.uint32(_ROTATE) | crc << np.uint32(32 - _ROTATE)) + np.uint32(_ADD)
    stored = sum(raw[8 + k : 8 + k + n].astype(np.uint32) << np.uint32(8 * k) for k in range(4))
    return np.flatnonzero(masked == stored)
