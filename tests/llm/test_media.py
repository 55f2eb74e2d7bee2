"""Transport streams: exact round trips, and errors that are planted."""

import random

import pytest

from helixframe.llm import media as M


def texts():
    rng = random.Random(3)
    return [b"", b"x", b" ", b"a" * 192, b"a" * 193, bytes(rng.randrange(256) for _ in range(100_000)), *(bytes(rng.randrange(256) for _ in range(n)) for n in range(3500, 4300, 7))]


def test_round_trip_and_structure():
    for text in texts():
        payload = M.padded(text)
        assert len(payload) % 192 == 0 and payload and payload.startswith(text)
        stream = M.mux(payload)
        assert len(stream) % 188 == 0
        found = M.demux(stream)
        assert b"".join(p["data"] for p in found["packets"]) == payload
        assert found["programs"] == {1: 0x1000} and found["streams"] == {0x100: 6}
        assert [found[k] for k in ("continuity_errors", "crc_errors", "sync_errors", "duplicates")] == [0] * 4
        assert all(p["complete"] for p in found["packets"])
        assert [p["pts"] for p in found["packets"]] == [k * 20 * 3003 for k in range(len(found["packets"]))]
        assert [p["random_access"] for p in found["packets"]] == [k % 8 == 0 for k in range(len(found["packets"]))]


def test_errors_are_counted():
    stream = M.mux(M.padded(b"q" * 20_000))
    packets = [stream[k : k + 188] for k in range(0, len(stream), 188)]
    assert M.demux(b"".join(packets[:10] + packets[11:]))["continuity_errors"] == 1
    twice = M.demux(b"".join(packets[:10] + packets[9:]))
    assert twice["duplicates"] == 1 and twice["continuity_errors"] == 0 and b"".join(p["data"] for p in twice["packets"]) == M.padded(b"q" * 20_000)
    broken = bytearray(packets[0])
    broken[10] ^= 1
    assert M.demux(b"".join([bytes(broken), *packets[1:]]))["crc_errors"] == 1
    assert M.demux(stream + b"tail")["sync_errors"] == 1
    assert M.demux(None)["packets"] == [] and M.demux(b"junk" * 100)["packets"] == []
    # known value: CRC-32/MPEG-2 of "123456789"
    assert M.crc_mpeg(b"123456789") == 0x0376E6E7


def payloads(found):
    return [p["data"] for p in found["packets"] if p["complete"]]


def test_a_lost_or_added_byte_costs_one_elementary_packet():
    rng = random.Random(5)
    for payload in (bytes(rng.randrange(256) for _ in range(192 * 20 * 17)), b"G" * 192 * 20 * 17):
        stream = M.mux(payload)
        whole = payloads(M.demux(stream))
        assert len(whole) == 17
        # not in the last packet, whose loss nothing follows
        for at in range(0, len(stream) - 188, 211):
            for broken in (stream[:at] + stream[at + 1 :], stream[:at] + b"\x00" + stream[at:]):
                found = M.demux(broken)
                left = payloads(found)
                # a payload of sync bytes alone may break the sync a second time
                assert 1 <= found["sync_errors"] <= (2 if payload[:1] == b"G" else 1) and len(left) >= 16 and set(left) <= set(whole), at


def test_sync_is_found_behind_junk_and_bursts():
    payload = M.padded(b"The Great G. " * 3000)
    stream = M.mux(payload)
    whole = M.demux(stream)
    for junk in (b"x" * 100, b"G" * 100, b"GG" * 500, b"\x47"):
        found = M.demux(junk + stream)
        assert b"".join(payloads(found)) == payload and found["sync_errors"] == 1
        # a long row of sync bytes is packets of no stream
        assert found["n_packets"] == whole["n_packets"] or len(junk) > M.LOCK * 188
    # a wrong sync byte: the packet goes, and the one before stays
    wrong = bytearray(stream)
    wrong[188 * 30] = 0
    assert M.demux(bytes(wrong))["n_packets"] == whole["n_packets"] - 1
    # a burst between two packets
    burst = stream[: 188 * 30] + b"\x01" * 700 + stream[188 * 30 :]
    assert len(M.demux(burst)["packets"]) == len(whole["packets"])
    assert M.demux(b"G")["packets"] == [] and M.demux(stream[:100])["packets"] == []


def test_tables_over_many_packets():
    """A table of 200 programs in one section of many packets, and two sections in one packet."""
    body = b"".join(k.to_bytes(2, "big") + (0xE000 | 0x1000 + k).to_bytes(2, "big") for k in range(1, 201))
    for shift in (0, 5):
        data = M.section(0, 1, body)
        # a pointer, the end of a section whose start is not there, then the section
        data = bytes([shift]) + b"\x00" * shift + data
        cuts = [data[k : k + 184] for k in range(0, len(data), 184)]
        head = lambda k, first: bytes([0x47, 0x40 if first else 0, 0, 0x10 | k & 15])
        packets = [head(k, k == 0) + c.ljust(184, b"\xff") for k, c in enumerate(cuts)]
        assert len(packets) == 5
        found = M.demux(b"".join(packets))
        assert found["programs"] == {k: 0x1000 + k for k in range(1, 201)} and found["crc_errors"] == 0
        # a gap inside: the section goes
        assert M.demux(b"".join(packets[:2] + packets[3:]))["programs"] == {}
    two = b"\x00" + M.section(0, 1, b"\x00\x01\xf0\x00") + M.section(0, 1, b"\x00\x02\xf0\x01")
    assert M.demux((head(0, True) + two).ljust(188, b"\xff"))["programs"] == {1: 0x1000, 2: 0x1001}


def test_table(spark):
    docs = spark.createDataFrame([(1, None, "z"), (None, "é" * 50_000, "z"), (2, "", None), (2, "", None)], "doc_id long, text string, media string")
    rows = {(r.doc_id, r.n_bytes): r for r in M.media_features(M.stored_media(docs)).collect()}
    assert set(rows) == {(1, 0), (None, 100_000), (2, 0)} and rows[(1, 0)].payload_bytes == 192
    assert rows[(1, 0)].media_sha256 == rows[(2, 0)].media_sha256
    assert M.media_features(M.encode_media(docs.limit(0))).count() == 0
    assert M.elementary_packets(M.encode_media(docs)).filter("random_access").count() >= 4
