"""Near-duplicate and substring operators against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velomesh.llm import chunk_dedup, simhash_trie as trie
from velomesh.llm.components import components
from velomesh.llm.queries import QUERIES
from velomesh.session import _shared_base

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


@given(st.text(alphabet="abcAÀé \t\n\x0b\x0c\x1c ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert trie.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "Bb", "ccc", "dé"], k=3000))
    whole = trie.fingerprint(text.encode())
    monkeypatch.setattr(trie, "BLOCK", 97)
    assert trie.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def clustered(seed, n=1500):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 7)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_walk_finds_every_link(distance, monkeypatch):
    values = np.array(clustered(distance), np.uint64)
    monkeypatch.setattr(trie, "FRONT", 300)
    got = set()
    for a, b in trie.trie_links(values, np.array([[0, len(values), 0, len(values)]]), distance):
        pairs = list(zip(a.tolist(), b.tolist()))
        assert not got & set(pairs)
        got |= set(pairs)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if int(values[i] ^ values[j]).bit_count() <= distance}
    assert got == want


@pytest.mark.parametrize("node_rows", [40, 50_000])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_connect_what_brute_force_connects(spark, node_rows, distance):
    values = clustered(7 + distance, 700)
    signed = [int(v) - (1 << 64 if v >> 63 else 0) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = trie.links(prints, distance, node_rows)
    found = {r.node: r.root for r in components(edges).collect()}
    want = plain_components(values, distance)
    mine = [found.get(v, v) for v in signed]
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))
    assert edges.count() <= (distance + 1) * len(values) * 2


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 180)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    for start in near:
        if near[start] == {start}:
            continue
        seen, todo = {start}, [start]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y), todo.append(y)
        assert got[start] == min(seen)


def test_registered_simhash_is_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_fingerprint(d.text) for d in docs]
    want = [(d.doc_id, f"{p:016x}", docs[c].doc_id) for d, p, c in zip(docs, prints, plain_components(prints))]
    assert sorted(map(tuple, QUERIES["op7_simhash"](spark, SMALL).collect())) == want


ODD = [(4, "one two three"), (9, None), (7, ""), (3, " \n"), (1, "x " * 50_000), (4, "ONE two\tthree"), (2, "one two three four"),
       (None, "one two three"), (None, "solo text here now")]


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"fp": F.lit(1), "root": F.lit("r"), "_own": F.lit(0)})
    got = trie.near_duplicates(docs).collect()
    assert len(got) == len(ODD)
    zero = [r.component_id for r in got if r.fingerprint == "0" * 16]
    assert zero == [3, 3, 3]
    kept = trie.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    groups = plain_components([plain_fingerprint(t) for _, t in ODD])
    assert len(rows) == len(set(groups))
    assert trie.near_duplicates(docs.where("false")).count() == 0 and trie.keep_one(docs.where("false")).count() == 0


def plain_borders(raw):
    """The gear hash byte by byte."""
    out, last, h = [], 0, 0
    for i, b in enumerate(raw):
        h = (h * 2 + int(chunk_dedup._GEAR[b])) % (1 << 32)
        e = i + 1
        if e < len(raw) and h < (1 << 32) // chunk_dedup.SPREAD and e - last >= chunk_dedup.LEAST_CHUNK and raw[e] & 0xC0 != 0x80:
            out.append(e)
            last = e
    return out + [len(raw)] * (last < len(raw))


def test_borders_are_the_rolling_hash(monkeypatch):
    rng = random.Random(2)
    for n in (0, 1, 31, 33, 5000):
        raw = "".join(rng.choice("abc é日\n") for _ in range(n)).encode()
        want = plain_borders(raw)
        assert chunk_dedup.borders(raw) == want
        monkeypatch.setattr(chunk_dedup, "BLOCK", 700)
        assert chunk_dedup.borders(raw) == want
        monkeypatch.undo()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdluéö", k=rng.randint(2, 9))) for _ in range(words))


def plain_dedup(rows, least=chunk_dedup.LEAST_BYTES):
    """Chunk by chunk: the first copy of a digest stays; each other is compared with it byte by byte to both sides.

    What touches is one stretch; a stretch of ``least`` bytes or more is cut.
    """
    def whole(raw, at):
        return at >= len(raw) or raw[at] & 0xC0 != 0x80

    raws = [(t or "").encode() for _, t in rows]
    # documents by identity, none last, then by the text's hash as a signed number
    own = [(i is None, i or 0, (h := xxhash.xxh64_intdigest(raw, 42)) - (h >> 63 << 64)) for (i, _), raw in zip(rows, raws)]
    first, parts = {}, []
    for me, raw in zip(own, raws):
        ends = plain_borders(raw)
        parts.append(list(zip([0, *ends], ends)))
        for s, e in parts[-1]:
            first[raw[s:e]] = min(first.get(raw[s:e], (me, s)), (me, s))
    text_of = dict(zip(own, raws))
    out = []
    for me, raw, cut, (i, t) in zip(own, raws, parts, rows):
        wide = []
        for s, e in cut:
            where, there = first[raw[s:e]]
            if (where, there) == (me, s):
                continue
            kept, left, right = text_of[where], 0, 0
            while left < min(s, there, chunk_dedup.WINDOW) and raw[s - left - 1] == kept[there - left - 1]:
                left += 1
            far = there + e - s
            while right < min(len(raw) - e, len(kept) - far, chunk_dedup.WINDOW) and raw[e + right] == kept[far + right]:
                right += 1
            while not whole(raw, s - left):
                left -= 1
            while not whole(raw, e + right):
                right -= 1
            wide.append((s - left, e + right))
        cuts = []
        for s, e in sorted(wide):
            if cuts and cuts[-1][1] >= s:
                cuts[-1] = (cuts[-1][0], max(cuts[-1][1], e))
            else:
                cuts.append((s, e))
        cuts = [c for c in cuts if c[1] - c[0] >= least]
        left = bytearray(raw)
        for s, e in reversed(cuts):
            del left[s:e]
        out.append((i, None if t is None else left.decode(), cuts))
    return out


def test_substring_dedup_is_brute_force(spark):
    passage = prose(1, 60)
    rows = [(k, prose(100 + k, 40 + k) + " " + passage + " " + prose(300 + k, 30)) for k in range(12)]
    rows += [(50 + k, prose(500 + k, 120)) for k in range(8)]
    rows += [(90, None), (91, ""), (92, passage * 40), (60, rows[0][1]), (93, "é" * 4000), (None, passage), (94, "x"), (94, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit("s"), "place": F.lit(1)}).repartition(3)
    got = chunk_dedup.deduplicate(docs).collect()
    key = lambda r: (repr(r[0]), repr(r[1]))
    mine = sorted(((r.doc_id, r.text, [tuple(s) for s in r.spans]) for r in got), key=key)
    assert mine == sorted(plain_dedup(rows), key=key)
    by = {r.doc_id: r for r in got}
    assert by[0].removed_bytes == 0
    # the passage goes from all later documents but for its edges, and clean documents stay
    assert all(by[k].removed_bytes > 0.5 * len(passage.encode()) and 0 in by[k].kept_in for k in range(1, 12))
    assert all(by[50 + k].removed_bytes == 0 for k in range(8))
    assert by[60].text == "" and by[90].text is None and by[91].text == ""


def test_substring_dedup_resists_shifts():
    a = prose(9, 400).encode()
    b = a[:700] + b"inserted" + a[700:]
    cut = lambda raw: {raw[s:e] for s, e in zip([0, *chunk_dedup.borders(raw)], chunk_dedup.borders(raw))}
    assert len(cut(a) - cut(b)) <= 3


def test_substring_dedup_of_an_empty_table(spark):
    assert chunk_dedup.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_substring_dedup_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.text, [tuple(s) for s in r.spans]) for r in QUERIES["op6_substring_dedup"](spark, SMALL).collect())
    assert got == sorted(plain_dedup(docs))


def test_substring_dedup_cuts_whole_passages(spark):
    """Passages of 51 words, short ones among them: whatever is found is cut from its first byte to its last."""
    rng, rows, passages = random.Random(7), [], {}
    for k in range(120):
        most = 3 + k % 6
        passages[1000 + k] = "¶" + " ".join("".join(rng.choices("etaoinshrdluéö", k=rng.randint(1, most))) for _ in range(51)) + "¶"
        rows += [(i, f"{prose(9000 + i, 40)} {i}{passages[1000 + k]}{i} {prose(19000 + i, 40)}") for i in (k, 1000 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in chunk_dedup.deduplicate(docs).collect()}
    texts, missed = dict(rows), 0
    for i, passage in passages.items():
        assert got[i - 1000].removed_bytes == 0
        if got[i].removed_bytes == 0:
            missed += 1
        else:
            # digits around the passage may agree by chance, nothing else
            assert passage not in got[i].text and len(passage.encode()) <= got[i].removed_bytes <= len(passage.encode()) + 6
            assert passage in texts[i].encode()[got[i].spans[0].start:got[i].spans[0].end].decode()
    assert missed <= 6


def test_substring_dedup_of_equal_and_null_identities(spark):
    """Different texts of one identity, or of none, are different documents: one of them keeps the passage."""
    for identity in (None, 7):
        passage = prose(1, 60)
        rows = [(identity, f"{prose(100 + k, 40)} {k}{passage}{k} {prose(300 + k, 30)}") for k in range(3)]
        rows += [rows[0]]
        got = chunk_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
        whole = [r.text for r in got if r.removed_bytes == 0]
        assert len(set(whole)) == 1 and passage in whole[0] and whole[0] in [t for _, t in rows]
        assert all(passage not in r.text and r.kept_in == [identity] for r in got if r.removed_bytes)


def test_substring_dedup_of_copies(spark):
    """A document whose text an earlier one has goes as a whole, and names all that keep its chunks."""
    passage, own = prose(1, 60), [prose(100 + k, 50) for k in range(3)]
    rows = [(1, f"{own[0]} {passage}"), (2, passage), (5, f"{own[1]} {passage} {own[1]}"), (9, f"{own[1]} {passage} {own[1]}"),
            (None, f"{own[1]} {passage} {own[1]}"), (6, own[2]), (7, own[2]), (7, own[2]), (5, f"{own[1]} {passage} {own[1]}"),
            (None, passage + own[2]), (None, passage + own[2]), (3, "short text"), (4, "short text"), (8, ""), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = chunk_dedup.deduplicate(docs).collect()
    assert sorted(((r.doc_id, r.text, [tuple(s) for s in r.spans]) for r in got), key=repr) == sorted(plain_dedup(rows), key=repr)
    kept = sorted(((r.doc_id, r.removed_bytes, r.kept_in) for r in got if r.text == ""), key=repr)
    whole = len(rows[2][1].encode())
    assert kept == sorted([(2, len(passage.encode()), [1]), (7, len(own[2].encode()), [6]), (7, len(own[2].encode()), [6]),
                           (9, whole, [1, 5]), (None, whole, [1, 5]), (8, 0, []), *[(None, len((passage + own[2]).encode()), [1, 2, 6])] * 2], key=repr)


def test_substring_dedup_keeps_little_on_disk(spark):
    """Texts with many short repeats and copies: what is stored between the steps stays near the size of the texts."""
    rng, same = random.Random(3), prose(1, 400).split(" ")
    rows = [(k, " ".join(rng.choice(same) + str(k) if i % 15 == 14 else w for i, w in enumerate(same))) for k in range(150)]
    rows += [(1000 + k, rows[k][1]) for k in range(150)]
    folder = Path(_shared_base(spark).removeprefix("file:"))
    files = lambda: {f: f.stat().st_size for f in folder.rglob("*.parquet") if f.relative_to(folder).parts[0].startswith("chunk-")}
    before = files()
    found = chunk_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    size = sum(n for f, n in files().items() if f not in before)
    assert size < 1.5 * sum(len(t.encode()) for _, t in rows)
    got = sorted((r.doc_id, r.text, [tuple(s) for s in r.spans]) for r in found.collect())
    assert got == sorted(plain_dedup(rows))


def test_bytes_beside_a_chunk_bound_its_growth():
    """Texts that agree in 16 or 64 bytes beside a place agree in the hashes of those bytes."""
    rng = random.Random(4)
    for _ in range(300):
        common, left, right = rng.randrange(600), rng.randbytes(rng.randrange(90)), rng.randbytes(rng.randrange(90))
        other = [rng.randbytes(rng.randrange(90)) for _ in range(2)]
        middle = rng.randbytes(common)
        at = rng.randrange(common + 1)
        one = chunk_dedup.beside(left + middle + right, np.array([len(left) + at]))[0]
        two = chunk_dedup.beside(other[0] + middle + other[1], np.array([len(other[0]) + at]))[0]
        for k, (reach, far) in enumerate([(at, 16), (at, 64), (common - at, 16), (common - at, 64)]):
            assert reach < far or one[k] == two[k]
