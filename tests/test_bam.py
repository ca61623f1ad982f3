"""BAM files written here by the format's rules and read back."""

import random
import struct
import zlib

import pytest

from weftline.sources import bam as bm
from weftline.sources import readers

REFS = ["1", "X", "MT"]


def block(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 12 + 6 + len(body) + 8
    return struct.pack("<4BIBBH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, size - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))


def bin_of(s: int, e: int) -> int:
    """The smallest bin that holds s to e (from 0, end exclusive)."""
    e -= 1
    for level in range(5, 0, -1):
        shift = 29 - 3 * level
        if s >> shift == e >> shift:
            return ((1 << 3 * level) - 1) // 7 + (s >> shift)
    return 0


def encoded(row) -> bytes:
    name, flag, ref, pos, cigar, seq, qual, tags = row
    packed = bytes((bm.BASES.index(seq[i]) << 4) | (bm.BASES.index(seq[i + 1]) if i + 1 < len(seq) else 0) for i in range(0, len(seq), 2))
    out = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, 30, bin_of(max(pos - 1, 0), max(pos, 1)), len(cigar), flag, len(seq), ref, pos - 1, 0)
    out += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | bm.CIGAR.index(op)) for n, op in cigar) + packed + bytes(ord(q) - 33 for q in qual) + tags
    return struct.pack("<i", len(out)) + out


def write_bam(path, rows, size: int = 300, indexed: bool = True) -> None:
    """Blocks of ``size`` bytes, so that records span them, an empty one inside, and an index."""
    head = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(head)) + head + struct.pack("<i", len(REFS))
    for name in REFS:
        data += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", 1 << 20)
    starts = []
    for row in rows:
        starts.append(len(data))
        data += encoded(row)
    starts.append(len(data))
    out, place = b"", []
    for k, at in enumerate(range(0, len(data), size)):
        place.append(len(out))
        out += block(data[at : at + size])
        if k == 1:
            out += block(b"")
    place.append(len(out))
    path.write_bytes(out + block(b""))
    virtual = lambda at: place[at // size] << 16 | at % size
    if indexed:
        text = b"BAI\x01" + struct.pack("<i", len(REFS))
        for ref in range(len(REFS)):
            bins: dict = {}
            linear: dict = {}
            for k, row in enumerate(rows):
                if row[2] == ref:
                    s = row[3] - 1
                    e = s + sum(n for n, op in row[4] if op in "MDN=X")
                    bins.setdefault(bin_of(s, e), []).append((virtual(starts[k]), virtual(starts[k + 1])))
                    for w in range(s >> 14, ((e - 1) >> 14) + 1):
                        linear.setdefault(w, virtual(starts[k]))
            text += struct.pack("<i", len(bins) + 1)
            for number, chunks in bins.items():
                text += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
            text += struct.pack("<IiQQQQ", bm.COUNTS_BIN, 2, 0, 0, 0, 0)
            known, last = [], 0
            for w in range(max(linear, default=-1) + 1):
                last = linear.get(w, last)
                known.append(last)
            text += struct.pack("<i", len(known)) + b"".join(struct.pack("<Q", v) for v in known)
        path.with_name(path.name + ".bai").write_bytes(text)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for k in range(300):
        n = rng.randint(1, 60)
        gap = rng.choice([0, 0, 30_000])
        cigar = [(n, "M")] if not gap or n < 2 else [(1, "M"), (gap, "N"), (n - 1, "M")]
        flag = rng.choice([0x41, 0x81]) | rng.choice([0, 0x10]) | (0x200 if k % 50 == 0 else 0)
        tags = b"NMC" + bytes([k % 5]) + b"MDZ" + str(n).encode() + b"\0" + (b"XBBs" + struct.pack("<ihh", 2, -3, 4) + b"XFf" + struct.pack("<f", 0.5) if k % 7 == 0 else b"")
        out.append((f"r{k // 2}", flag, rng.randrange(2), rng.randint(1, 200_000), cigar, "".join(rng.choices("ACGTN", k=n)), "".join(rng.choices("!#5I", k=n)), tags))
    out.sort(key=lambda r: (r[2], r[3]))
    return out + [("lost", 0x45, -1, 0, [], "ACG", "III", b"")]


def expected(row):
    length = sum(n for n, op in row[4] if op in "MDN=X")
    return row[0], row[1], REFS[row[2]] if row[2] >= 0 else "*", row[3], "".join(f"{n}{op}" for n, op in row[4]) or "*", row[5], row[6], row[3] - 1 + max(length, 1)


def found(df):
    return sorted((r.qname, r.flag, r.rname, r.pos, r.cigar, r.seq, r.qual, r.ref_end) for r in df.collect())


@pytest.mark.parametrize("indexed", [True, False])
def test_whole_files_in_parts_and_regions(spark, rows, tmp_path, indexed):
    path = tmp_path / "x.bam"
    write_bam(path, rows, indexed=indexed)
    whole = bm.bam(spark, str(path), split_bytes=700)
    assert (whole.rdd.getNumPartitions() > 5) == indexed
    assert found(whole) == sorted(map(expected, rows))
    for name, s, e, strand in (("1", 1, 200_100, None), ("X", 40_000, 60_000, "-"), ("X", 40_000, 60_000, "+"), ("1", 16_384, 16_385, None), ("MT", 1, 100, None), ("none", 1, 9, None)):
        want = [x for x in map(expected, rows) if x[2] == name and x[3] <= e and x[7] >= s and (strand is None or (x[1] & 0x10 != 0) == (strand == "-"))]
        assert found(bm.bam_region(spark, f"file://{path}", name, s, e, strand)) == sorted(want)


def test_columns_feed_the_other_readers(spark, rows, tmp_path):
    write_bam(tmp_path / "a.bam", rows[:100])
    write_bam(tmp_path / "b.bam", rows[100:], indexed=False)
    write_bam(tmp_path / "c.bam", [])
    read = bm.bam(spark, str(tmp_path))
    tags = {r.tags for r in read.where("qname <> 'lost'").collect()}
    assert all(t.startswith("NM:i:") and "\tMD:Z:" in t for t in tags) and any(t.endswith("XB:B:s,-3,4\tXF:f:0.5") for t in tags)
    got = {(r.fragment, r.read_end, r.ref_name, r.strand, r.s, r.e) for r in readers.alignments(read, "ref_end").collect()}
    assert got == {(x[0], 0 if x[1] & 0x40 else 1, x[2], "-" if x[1] & 0x10 else "+", x[3], x[7]) for x in map(expected, rows[:-1])}
    both, alone = readers.paired_mates(bm.mates(read))
    ends = {}
    for r in rows:
        ends.setdefault(r[0], []).append(r)
    ok = lambda a, b: not (a[1] | b[1]) & 0x200
    pairs = sum(ok(a, b) for x in ends.values() for a in x for b in x if a[1] & 0x40 and b[1] & 0x80)
    assert both.count() == pairs and alone.where("name = 'lost'").count() == 1


def test_faulty_files_are_refused(tmp_path):
    (tmp_path / "x.bam").write_bytes(b"no blocks here at all")
    with pytest.raises(ValueError, match="no block"), bm.opened(str(tmp_path / "x.bam")) as file:
        bm.header(file)
    with pytest.raises(ValueError, match="index"):
        bm.index(b"BAM\x01")
