"""MPEG transport streams as binary columns.

`mux` stores payloads as transport streams of 188-byte packets: a program association table, a program map table,
and one elementary stream in PES packets with time stamps, the first of every group marked as a random access
point. `demux` parses any such stream: it finds the packets again where bytes are lost or added, joins the tables'
sections and checks their CRC, checks continuity counters (a packet may be sent twice, and a discontinuity may be
announced), reassembles the elementary packets of each stream and returns their time stamps and random access points.

Samples are 8-bit and come in units of UNIT; a payload is padded with spaces to a positive multiple of UNIT.

Defined results: null text is empty; equal texts give equal streams; a null stream has no units. Of a broken stream, a
packet that loses or gains bytes goes, and an elementary packet with a gap ends there and is not complete; errors are
counted; a stream without sync has no units; a null id stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import slices, written

UNIT = 192
UNITS_A_PES, PES_A_GROUP = 20, 8
#: Fixed values of the format: packet size, sync byte, identifiers, stream type of private data in PES packets.
PACKET, SYNC, PAT_PID, PMT_PID, ES_PID, PROGRAM, PRIVATE_TYPE, PRIVATE_ID, NULL_PID = 188, 0x47, 0, 0x1000, 0x100, 1, 0x06, 0xBD, 0x1FFF
#: The 90 kHz clock's ticks for one unit.
TICKS = 3003
STAMP = 1 << 33


def padded(text: bytes) -> bytes:
    return text + b" " * (-len(text) % UNIT if text else UNIT)


def crc_table() -> list[int]:
    """CRC-32 as MPEG uses it: polynomial 0x04C11DB7, most significant bit first."""
    out = []
    for v in range(256):
        c = v << 24
        for _ in range(8):
            c = (c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1
        out.append(c & 0xFFFFFFFF)
    return out


CRC = crc_table()


def crc_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ CRC[(c >> 24) ^ b]
    return c


def section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + crc_mpeg(head).to_bytes(4, "big")


def table_packet(pid: int, section: bytes) -> bytearray:
    return bytearray((bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff"))


PAT = table_packet(PAT_PID, section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
PMT = table_packet(PMT_PID, section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00"))


def stamp(mark: int, t: int) -> bytes:
    """A 33-bit time stamp in five bytes."""
    return bytes([mark << 4 | (t >> 30 & 7) << 1 | 1, t >> 22 & 255, (t >> 15 & 127) << 1 | 1, t >> 7 & 255, (t & 127) << 1 | 1])


def clock(t: int) -> bytes:
    """A program clock reference without extension."""
    return (t << 15 | 0x7E00).to_bytes(6, "big")


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload, whose length is a multiple of UNIT."""
    out: list[bytes] = []
    tables, counter = 0, 0
    for k, at in enumerate(range(0, len(payload), UNIT * UNITS_A_PES)):
        entry = k % PES_A_GROUP == 0
        if entry:
            for packet in (PAT, PMT):
                packet[3] = 0x10 | tables & 15
                out.append(bytes(packet))
            tables += 1
        t = at // UNIT * TICKS % STAMP
        data = payload[at : at + UNIT * UNITS_A_PES]
        pes = b"\x00\x00\x01" + bytes([PRIVATE_ID]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + stamp(2, t) + data
        place, first = 0, True
        while place < len(pes):
            field = b""
            if first and entry:
                field = b"\x50" + clock(t)
            room = PACKET - 4 - (len(field) + 1 if field else 0)
            left = len(pes) - place
            if left < room:
                lack = room - left
                if not field:
                    # the length byte, then the flags, then stuffing
                    field, lack = (b"", 0) if lack == 1 else (b"\x00", lack - 2)
                    adaptation = bytes([0]) if not field else bytes([1 + lack]) + field + b"\xff" * lack
                else:
                    adaptation = bytes([len(field) + lack]) + field + b"\xff" * lack
            else:
                adaptation = bytes([len(field)]) + field if field else b""
            size = PACKET - 4 - len(adaptation)
            control = 0x30 if adaptation else 0x10
            out += [bytes([SYNC, (0x40 if first else 0) | ES_PID >> 8, ES_PID & 255, control | counter & 15]), adaptation, pes[place : place + size]]
            place, first, counter = place + size, False, counter + 1
    return b"".join(out)


def read_stamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1


def read_section(section: bytes) -> tuple[int, int, bytes] | None:
    """(table, number, body) of a section whose length and CRC hold."""
    if len(section) < 12 or len(section) != section_size(section) or crc_mpeg(section):
        return None
    return section[0], section[3] << 8 | section[4], section[8:-4]


def section_size(section: bytes) -> int:
    return 3 + ((section[1] & 15) << 8 | section[2])


def joined_sections(bodies: Iterator[tuple[bool, bool, bytes]]) -> Iterator[bytes]:
    """Sections of a table's packets (starts a section, comes after a gap, body), which may be many to a packet or go over many.

    A section that the next one or the end cuts short comes out as it is, and fails its check; one with a gap goes.
    """
    held: bytes | None = None
    for first, gap, body in bodies:
        if gap:
            held = None
        if first:
            begin = 1 + body[0] if body else 1
            if held is not None:
                held += body[1:begin]
                yield held[: section_size(held)] if len(held) >= 3 else held
            held = body[begin:]
            if not held:
                yield b""
        elif held is not None:
            held += body
        while held and held[0] != 0xFF and len(held) >= 3 and len(held) >= (size := section_size(held)):
            yield held[:size]
            held = held[size:]
        # stuffing fills the rest of a packet
        if not held or held[0] == 0xFF:
            held = None
    if held is not None:
        yield held


#: Packets in a row that make a lock.
LOCK = 4


def packet_places(stream: bytes) -> tuple[np.ndarray, int]:
    """(places of the packets, how often the sync is lost).

    In lock, a packet with a wrong sync byte is left out if the next ones are in place. Where they aren't, the packet before
    has lost or gained bytes and goes, and the search starts behind its first byte: of the places that LOCK sync bytes
    follow at the packets' distance, or all to the end, those within a packet of the first compete; the one whose packets
    fill the stream to its end wins, then the one with most packets in a row, then the first.
    """
    x = np.frombuffer(stream, np.uint8)
    n = len(x)
    if n % PACKET == 0 and (x[::PACKET] == SYNC).all():
        return np.arange(0, n, PACKET), 0
    rows = n // PACKET + 2
    sync = np.zeros(rows * PACKET, bool)
    sync[:n] = x == SYNC
    # packets in a row from each place: the next row without sync, by column
    number = np.arange(rows, dtype=np.int32)[:, None]
    ends = np.minimum.accumulate(np.where(sync.reshape(rows, PACKET), np.int32(rows), number)[::-1])[::-1]
    chain = (ends - number).ravel()
    place = np.arange(len(chain))
    reach = place + chain.astype(np.int64) * PACKET
    locks = np.flatnonzero((chain > 0) & (place + PACKET <= n) & ((chain >= LOCK) | (reach >= n)))

    def lock(after: int) -> int | None:
        k = np.searchsorted(locks, after)
        if k == len(locks):
            return None
        near = locks[k : np.searchsorted(locks, locks[k] + PACKET)]
        return int(near[np.lexsort((near, -chain[near], reach[near] != n))[0]])

    found: list[np.ndarray] = []
    p = lock(0)
    lost = int(p != 0)
    while p is not None:
        past = int(min(reach[p], p + (n - p) // PACKET * PACKET))
        found.append(np.arange(p, past, PACKET))
        if past == n:
            break
        lost += 1
        after = past + PACKET
        if after + PACKET <= n and (chain[after] >= LOCK or (chain[after] > 0 and reach[after] == n)):
            p = after
            continue
        p = lock(past - PACKET + 1)
        if p is not None:
            run, early = found[-1], p < past - PACKET // 2
            # a lock just behind the last packet's start: bytes were added, and packets since then were ones by chance
            while early and p - PACKET > run[0] and sync[p - PACKET]:
                p -= PACKET
            clear = run[run + PACKET <= p]
            found[-1] = clear[:-1] if early or len(clear) == len(run) else clear
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), lost


def demux(stream: bytes | None) -> dict:
    """Programs, elementary packets by stream in order, and counts of errors.

    {"programs": {number: pmt pid}, "streams": {pid: type}, "packets": [{pid, pts, dts, random_access, data}],
    "n_packets", "continuity_errors", "duplicates", "crc_errors", "sync_errors", "scrambled"}
    """
    found: dict = {"programs": {}, "streams": {}, "packets": [], "n_packets": 0, "continuity_errors": 0, "duplicates": 0, "crc_errors": 0, "sync_errors": 0, "scrambled": 0}
    stream = stream or b""
    places, found["sync_errors"] = packet_places(stream)
    found["n_packets"] = n = len(places)
    if not n:
        return found
    raw = np.lib.stride_tricks.sliding_window_view(np.frombuffer(stream, np.uint8), PACKET)[places]
    head = raw[:, 1:6].astype(np.int64)
    pid = (head[:, 0] & 31) << 8 | head[:, 1]
    start, error = (head[:, 0] & 0x40) > 0, (head[:, 0] & 0x80) > 0
    scrambled, control, counter = head[:, 2] >> 6, head[:, 2] >> 4 & 3, head[:, 2] & 15
    has_field, has_data = (control & 2) > 0, (control & 1) > 0
    flags = np.where(has_field & (head[:, 3] > 0), head[:, 4], 0)
    skip = np.minimum(np.where(has_field, 5 + head[:, 3], 4), PACKET)
    found["scrambled"] = int((scrambled > 0).sum())
    usable = ~error & (scrambled == 0) & (pid != NULL_PID)

    tables: dict[int, str] = {PAT_PID: "pat"}
    use: dict[int, np.ndarray] = {}
    for p in np.unique(pid[usable]).tolist():
        at = np.flatnonzero(usable & (pid == p))
        c, d = counter[at], has_data[at]
        step = (c[1:] - c[:-1]) & 15
        same = np.zeros(len(at), bool)
        same[1:] = (step == 0) & d[1:] & d[:-1]
        # one repetition of a packet is allowed
        repeat = same.copy()
        repeat[1:] &= ~same[:-1]
        if repeat.any():
            repeat[np.flatnonzero(repeat)] = [bool((raw[at[k], 4:] == raw[at[k - 1], 4:]).all()) for k in np.flatnonzero(repeat)]
        announced = (flags[at] & 0x80) > 0
        bad = np.zeros(len(at), bool)
        bad[1:] = (step != d[1:]) & ~repeat[1:] & ~announced[1:]
        found["continuity_errors"] += int(bad.sum())
        found["duplicates"] += int(repeat.sum())
        use[p] = np.stack([at[~repeat & d], bad[~repeat & d]])

    def sections(p: int) -> Iterator[tuple[int, int, bytes]]:
        seen: set[bytes] = set()
        at, gap = use.get(p, np.zeros((2, 0), int))
        for body in joined_sections((bool(start[k]), bool(g), raw[k, skip[k] :].tobytes()) for k, g in zip(at, gap, strict=True)):
            if body in seen:
                continue
            seen.add(body)
            if (got := read_section(body)) is None:
                found["crc_errors"] += 1
            else:
                yield got

    for table, _, body in sections(PAT_PID):
        for k in range(0, len(body) - 3, 4) if table == 0 else ():
            if number := body[k] << 8 | body[k + 1]:
                found["programs"][number] = (body[k + 2] & 31) << 8 | body[k + 3]
    for p in sorted(set(found["programs"].values()) - set(tables)):
        for table, _, body in sections(p):
            if table != 2 or len(body) < 4:
                continue
            k = 4 + ((body[2] & 15) << 8 | body[3])
            while k + 5 <= len(body):
                found["streams"][(body[k + 1] & 31) << 8 | body[k + 2]] = body[k]
                k += 5 + ((body[k + 3] & 15) << 8 | body[k + 4])

    for p in sorted(found["streams"]):
        at, bad = use.get(p, np.zeros((2, 0), int))
        firsts = np.flatnonzero(start[at])
        for lo, hi in zip(firsts, np.append(firsts[1:], len(at)), strict=True):
            # what comes after a gap has no known place
            gaps = np.flatnonzero(bad[lo + 1 : hi])
            past = lo + 1 + gaps[0] if len(gaps) else hi
            body = b"".join(raw[k, skip[k] :].tobytes() for k in at[lo:past])
            if len(body) < 9 or body[:3] != b"\x00\x00\x01":
                found["crc_errors"] += 1
                continue
            size = body[4] << 8 | body[5]
            data = body[9 + body[8] : 6 + size if size else None]
            pts = read_stamp(body[9:14]) if body[7] & 0x80 and len(body) >= 14 else None
            dts = read_stamp(body[14:19]) if body[7] & 0xC0 == 0xC0 and len(body) >= 19 else pts
            found["packets"].append({"pid": p, "pts": pts, "dts": dts, "random_access": bool(flags[at[lo]] & 0x40), "complete": len(body) >= 6 + size if size else past == hi, "data": data})
    return found


def feature(found: dict) -> str:
    packets = found["packets"]
    stamps = [p["pts"] for p in packets if p["pts"] is not None]
    entries = [p["pts"] for p in packets if p["random_access"]]
    parts = {
        "programs": "/".join(map(str, sorted(found["programs"]))), "streams": "/".join(f"{p}:{t}" for p, t in sorted(found["streams"].items())),
        "packets": found["n_packets"], "pes": len(packets), "first_pts": stamps[0] if stamps else "", "last_pts": stamps[-1] if stamps else "",
        "random_access": len(entries), "entry_pts": "/".join(map(str, entries)), "continuity_errors": found["continuity_errors"], "crc_errors": found["crc_errors"], "sync_errors": found["sync_errors"],
    }
    return ";".join(f"{k}={v}" for k, v in parts.items())


def encode_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: id_col, n_bytes (unpadded), and `media`, its transport stream."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = pc.fill_null(part.column("text").cast(pa.binary()), b"").to_pylist()
            media = pa.array([mux(padded(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(t) for t in texts], pa.int64()), media], names=["id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


FEATURES = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, continuity_errors long, n_pes long, n_random_access long"


def media_features(media: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Digests and features of each stream, from the stored bytes."""

    def one(i, n, stream: bytes | None) -> tuple:
        found = demux(stream)
        payload = b"".join(p["data"] for p in found["packets"])
        stream = stream or b""
        return (i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stream), hashlib.sha256(stream).hexdigest(), feature(found), found["continuity_errors"], len(found["packets"]), sum(p["random_access"] for p in found["packets"]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FEATURES.split(", ")]
        for part in slices(batches, "media"):
            rows = [one(*row) for row in zip(*(part.column(k).to_pylist() for k in ("id", "n_bytes", "media")), strict=True)]
            columns = [pa.array(c, pa.string() if k in (3, 6, 7) else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col("n_bytes").cast("long").alias("n_bytes"), F.col("media").cast("binary").alias("media"))
    return rows.mapInArrow(step, FEATURES).withColumnRenamed("id", id_col)


def elementary_packets(media: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """One row for each elementary packet: id_col, pid, ordinal, pts, dts, random_access, complete, data."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("pid", pa.int64()), ("ordinal", pa.int64()), ("pts", pa.int64()), ("dts", pa.int64()), ("random_access", pa.bool_()), ("complete", pa.bool_()), ("data", pa.binary())])
        for part in slices(batches, "media"):
            rows = [{"id": i, "ordinal": k, **p} for i, m in zip(part.column("id").to_pylist(), part.column("media").to_pylist(), strict=True) for k, p in enumerate(demux(m)["packets"])]
            yield pa.RecordBatch.from_pylist(rows, schema)

    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col("media").cast("binary").alias("media"))
    return rows.mapInArrow(step, "id long, pid long, ordinal long, pts long, dts long, random_access boolean, complete boolean, data binary").withColumnRenamed("id", id_col)


def stored_media(docs: DataFrame, **columns: str) -> DataFrame:
    """encode_media's rows, written to the shared folder and read back."""
    return written(encode_media(docs, **columns), "media")
