"""Operators that compare documents with each other, against brute force over all pairs."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import texts
from texts import docs  # noqa: F401
from marquee.llm import lines, sharding, simhash, substrings, suffixes
from marquee.llm.graph import components


def plain_components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    draw = random.Random(1)
    pairs = {
        "random": [(draw.randrange(300), draw.randrange(300)) for _ in range(220)],
        "path": [(i * 7 % 101, (i + 1) * 7 % 101) for i in range(100)],
        "star": [(50, i) for i in range(100) if i != 50],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    want = plain_components([p for p in pairs if p[0] != p[1]])
    assert {r["node"]: r["root"] for r in found} == want and len(found) == len(want)


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [plain_print(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1) if (prints[i] ^ prints[j]).bit_count() <= 3]
    group = plain_components(pairs)
    least = {}
    for i, root in group.items():
        if rows[i][0] is not None:
            least[root] = min(least.get(root, 1 << 62), rows[i][0])
    want = Counter((rows[i][0], f"{prints[i]:016x}", least.get(group[i])) for i in range(len(rows)))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    kept = simhash.keep_first(docs)
    assert kept.count() == len(set(group.values())) and kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(least.values()) | ({None} if len(least) < len(set(group.values())) else set())


@pytest.mark.parametrize("bucket", [2, 10, 4096])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    draw = random.Random(2)
    centres = [draw.getrandbits(64) for _ in range(30)]
    found = {centres[draw.randrange(30)] ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(4))) & ((1 << 64) - 1) for _ in range(600)}
    signed = sorted(x - (x >> 63 << 64) for x in found)
    rows = spark.createDataFrame([(x,) for x in signed], "bits bigint")
    got = components(simhash.links(rows, 3, bucket)).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3]
    assert {r["node"]: r["root"] for r in got} == plain_components(near)


def test_masks_cover_every_difference():
    draw = random.Random(3)
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    for _ in range(5000):
        flips = sum(1 << b for b in draw.sample(range(64), 3))
        found = [m for m in masks if not m & flips]
        assert found
        free = ~found[0] & ((1 << 64) - 1)
        assert any(not m & flips for m in simhash.covering_masks(3, free))
        assert free.bit_count() <= 32 and min(m.bit_count() for m in simhash.covering_masks(3, free)) >= 12


def test_shards(spark, docs):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    found = sharding.shard_documents(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((i, len(t) + 8, zlib.crc32(t)) for i, t in rows)
    check_shards(found, len(rows))


def check_shards(found, n):
    counts = Counter(r["shard"] for r in found)
    assert set(counts) <= set(range(24)) and max(counts.values()) - min([counts[s] for s in range(24)]) <= 1 and sum(counts.values()) == n
    for s in counts:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))


@pytest.mark.parametrize("shape", ["third", "all", "few", "unique"])
def test_shards_of_skewed_texts(spark, shape):
    text = {"third": F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")), "all": F.lit("same"), "few": (F.col("id") % 40).cast("string"), "unique": F.col("id").cast("string")}[shape]
    found = sharding.shard_documents(spark.range(2000).select(F.col("id").alias("doc_id"), text.alias("text"))).collect()
    check_shards(found, 2000)
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in found)
    split = {}
    for r in found:
        if r["linked"]:
            split.setdefault(r["text_crc32"], set()).add(r["shard"])
    if shape == "third":
        assert len(split) == 1 and max(map(len, split.values())) <= 16


def test_small_groups_stay_together(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, F.col("id") % 100).otherwise(F.col("id")).cast("string").alias("text"))
    groups = {}
    for r in sharding.shard_documents(rows).collect():
        groups.setdefault((r["text_crc32"], r["linked"]), set()).add(r["shard"])
    assert all(len(s) == 1 for (_, linked), s in groups.items() if linked)


def plain_cut(rows, length=50):
    first = {}
    for i, raw in rows:
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            first[w] = min(first.get(w, 1 << 62), i)
    out = []
    for i, raw in rows:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < i:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), int((gone & ~np.concatenate(([False], gone[:-1]))).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, seed):
    draw = random.Random(seed)
    found = [(i, t) for i, t, *_ in texts.rows(seed)]
    found += [(600, "ab" * 300), (601, "ab" * 400), (602, "x" * 49), (603, "x" * 50), (604, "x" * 120), (605, "ü" * 200), (606, "aü" + "ü" * 90)]
    found += [(700 + i, "".join(draw.choice("ab") for _ in range(300))) for i in range(20)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string").repartition(3)
    rows = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in found]
    want = Counter((None if i == (1 << 63) - 1 else i, *rest) for i, *rest in plain_cut(rows))
    assert Counter(map(tuple, substrings.remove_repeats(docs).drop("kept").collect())) == want


def test_shards_do_not_get_every_occurrence(spark):
    """What is dealt to the shards does not grow with the documents that share a passage, and all but one lose it."""
    passage = "".join(random.Random(8).choice("abcdefgh ") for _ in range(400))

    def docs(n):
        return spark.createDataFrame([(i, passage) for i in range(n)], "doc_id bigint, text string").coalesce(1)

    def dealt(n):
        found = substrings.send_segments(docs(n), 64, substrings.shared_keys(docs(n), 64)).select(*substrings.SEGMENTS)
        return sum(len(v) for r in found.collect() for v in r if isinstance(v, (bytes, bytearray)))

    assert dealt(20) == dealt(2000) > 0
    lost = substrings.remove_repeats(docs(2000)).groupBy("n_removed", "n_spans").count().collect()
    assert sorted(tuple(r) for r in lost) == [(0, 0, 1), (400, 1, 1999)]


def test_suffix_order():
    draw = random.Random(4)
    for _ in range(600):
        text = np.array([draw.randrange(draw.choice([2, 3, 6])) for _ in range(draw.randrange(40))] + [0])
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffixes.suffix_order(text, budget=draw.choice([1, 5, 1 << 20])).tolist() == want
        assert suffixes.doubled(text + 0).tolist() == want or text.max() == 0 or len(text) < 2


def test_equal_windows_share_a_key():
    raw = bytes(random.Random(5).choice(b"abcd") for _ in range(400))
    keys = substrings.window_keys(np.frombuffer(raw * 2, dtype=np.uint8))
    assert (keys[:351] == keys[400:]).all() and len(keys) == 751


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def plain_line(raw):
    return " ".join(w for w in raw.lower().replace("\t", " ").replace("\r", " ").split(" ") if w)


def fuzzy_rows():
    draw = random.Random(6)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(500)]
    base = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 90))) for _ in range(40)]
    out = []
    for i in range(90):
        own = []
        for _ in range(draw.randrange(1, 6)):
            line = draw.choice(base).split()
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                line[draw.randrange(len(line))] = draw.choice(words)
            own.append(draw.choice([" ", "  ", "\t"]).join(line) + draw.choice(["", " ", "\r"]))
        own.append(draw.choice(["", "  ", "Same Line", "same  line"]))
        out.append((1000 - i, "\n".join(own)))
    return [*out, (5, None), (6, ""), (7, "\n\n"), (None, out[0][1])]


def similar(a, b):
    return abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and edit(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def plain_gone(rows):
    """Per row, the places of the lines that go, by edit similarity of all pairs."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    found = [(r, place, norm) for r in order for place, raw in enumerate((rows[r][1] or "").split("\n")) if (norm := plain_line(raw))]
    norms = sorted({n for *_, n in found})
    pairs = [(n, n) for n in norms] + [(a, b) for i, a in enumerate(norms) for b in norms[:i] if similar(a, b)]
    group, seen, gone = plain_components(pairs), set(), {}
    for r, place, norm in found:
        if group[norm] in seen:
            gone.setdefault(r, []).append(place)
        seen.add(group[norm])
    return gone, len(norms), len(set(group.values()))


def test_fuzzy_lines(spark):
    rows = fuzzy_rows()
    gone, distinct, groups = plain_gone(rows)
    assert groups < distinct
    docs = spark.createDataFrame([(i, t, "en", "src", 0 if t is None else len(t)) for i, t in rows], texts.SCHEMA).repartition(3)
    report = {r["doc_id"]: r["removed"] for r in lines.line_report(docs).collect()}
    assert set(report) == {rows[r][0] for r in range(len(rows)) if any(map(plain_line, (rows[r][1] or "").split("\n")))}
    want = {rows[r][0]: set(places) for r, places in gone.items()}
    assert all(set(places) <= want.get(i, set()) for i, places in report.items())
    assert sum(map(len, report.values())) >= 0.95 * sum(map(len, want.values()))
    kept = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    for i, text in rows:
        left = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in report.get(i, []))
        assert kept[i]["text"] == left and kept[i]["n_chars"] == len(left or "")


def test_block_prints_are_simhashes(spark):
    draw = random.Random(9)
    sets = [[draw.getrandbits(64) - (1 << 63) for _ in range(n)] for n in [*range(1, lines.COUNTED + 1)] * 3]
    df = spark.createDataFrame([(s,) for s in sets], "words array<bigint>").select("words", lines.simhash_block(F.col("words")).alias("bits"))
    for words, bits in df.collect():
        want = sum(1 << b for b in range(64) if 2 * sum(w >> b & 1 for w in words) > len(words))
        assert bits % (1 << 64) == want


def test_block_prints_count_all_words(spark):
    draw = random.Random(23)
    sets = [[draw.getrandbits(64) - (1 << 63) for _ in range(n)] for n in [16, 17, 31, 32, 40, 100]]
    df = spark.createDataFrame([(s,) for s in sets], "words array<bigint>").select("words", lines.simhash_block(F.col("words")).alias("bits"))
    for words, bits in df.collect():
        assert bits % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(w >> b & 1 for w in words) > len(words))


def test_lines_that_share_high_blocks_only(spark):
    """Every word of the lowest blocks is altered: what the lines share stands in all others."""
    draw = random.Random(22)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(4000)]
    number = spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    low = {r["w"] for r in number if r["h"] < -(1 << 63) + (1 << 62)}  # a quarter of the blocks
    out = []
    for _ in range(20):
        line = draw.sample(vocabulary, 110)
        out += [" ".join(line), " ".join(w[:4] + "z" + w[5:] if w in low else w for w in line)]
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string")
    blocks = {r["doc_id"]: len(r["buckets"]) for r in lines._lines(docs).collect()}
    assert min(blocks.values()) > 2 * lines.KEPT
    assert {r["doc_id"] for r in lines.line_report(docs).filter("n_removed = 1").collect()} == set(range(1, 40, 2))


def test_fewer_changes_than_blocks_leave_a_block(spark):
    """Of the blocks that are kept, one is left if fewer words change than are kept."""
    draw = random.Random(10)
    rows, vocabulary = [], ["".join(draw.choice("abcdefgh") for _ in range(9)) for _ in range(5000)]
    for i in range(200):
        line = draw.sample(vocabulary, 28)
        other = list(line)
        for at in draw.sample(range(28), (lines.KEPT - 1) // 2):  # each of them changes two blocks at most
            other[at] = draw.choice(vocabulary)
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(draw.sample(other, 28)))]
    kept = {r["doc_id"]: set(r["buckets"]) for r in lines._lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(kept[2 * i] & kept[2 * i + 1] for i in range(200))
    assert max(map(len, kept.values())) <= 2 * lines.KEPT


def test_repeated_rows_and_hot_lines(spark):
    rows = [(i, "the same line everywhere\nown words number " + "x" * (i % 50)) for i in range(600)]
    rows += [(3, "twin\nrows")] * 3 + [(None, "nameless twin\nof itself")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    report = lines.line_report(docs)
    assert report.filter("doc_id = 3 and n_lines = 2").agg(F.sum("n_removed")).first()[0] == 4 + 2
    assert sorted(r["n_removed"] for r in report.filter("doc_id is null").collect()) == [0, 2, 2]
    kept = lines.dedup_lines(docs)
    assert kept.count() == 606
    assert kept.filter("text like '%twin%'").count() == 2 and kept.filter("text like '%the same line everywhere%'").count() == 1


@pytest.mark.parametrize("n", [500, 1000])
def test_shared_passages_make_few_pairs(spark, n):
    """Lines that share half of their words and are unlike otherwise: pairs grow with the lines, and none goes."""
    draw = random.Random(13)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(8))
    common = [word() for _ in range(7)]
    rows = [(i, " ".join(common + [word() for _ in range(7)])) for i in range(n)]
    rows += [(n + i, rows[i][1] + " more") for i in range(0, n, 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    occurrences = lines.materialize(lines._lines(docs), "few")
    assert lines.candidate_pairs(occurrences).count() <= 12 * n
    assert lines.line_report(docs).agg(F.sum("n_removed")).first()[0] == n // 50


def test_lines_are_found_by_edit_similarity_alone(spark):
    """The truth knows no fingerprints: lines of one word replaced mostly differ in more bits than a radius allows."""
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(3, 9))) for _ in range(300)]
    out = []
    for n in [8, 10, 12, 16, 20, 25, 30, 40] * 3:
        line = [draw.choice(words) for _ in range(n)]
        other = list(line)
        other[draw.randrange(n)] = draw.choice(words)
        out += [" ".join(line), " ".join(other)]
    norms = sorted(set(out))
    pairs = [(a, b) for i, a in enumerate(norms) for b in norms[:i] if similar(a, b)]
    assert len(pairs) >= 20
    truth = plain_components([*pairs, *((n, n) for n in norms)])
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string")
    gone = {r["doc_id"] for r in lines.line_report(docs).filter("n_removed > 0").collect()}
    seen, want = set(), set()
    for i, line in enumerate(out):
        if truth[line] in seen:
            want.add(i)
        seen.add(truth[line])
    assert gone <= want and len(gone) >= 0.95 * len(want)
    kept = {r["doc_id"] for r in lines.dedup_lines(docs).filter("text <> ''").collect()}
    assert kept == set(range(len(out))) - gone


def crowded_rows():
    """Pairs of lines changed in most words, each with the words that all lines share: some meet in one crowded block only."""
    draw, rows = random.Random(17), []
    word = lambda n: "".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    for n, common, kept in [(4, ["everywhere"], 0)] * 200 + [(12, ["everywhere", "standing"], 3)] * 50:
        line = [word(9) for _ in range(n - len(common))]
        other = [w if i < kept else w[:-1] + "x" for i, w in enumerate(line)]
        rows += [" ".join(common + line), " ".join(common + other)]
    return rows


@pytest.mark.parametrize("cell", [lines.SMALL // 4, 1000])
def test_all_lines_that_share_a_block_are_compared(spark, monkeypatch, cell):
    """Against brute force over all pairs that share a block, however crowded it is, and whatever the size of a cell."""
    monkeypatch.setattr(lines, "CELL", cell, raising=False)
    docs = spark.createDataFrame(list(enumerate(crowded_rows())), "doc_id bigint, text string")
    occurrences = lines.materialize(lines._lines(docs), "crowded")
    texts_of, buckets = dict(docs.collect()), {}
    key = {r["line"]["x"]: texts_of[r["doc_id"]] for r in occurrences.collect()}
    for r in occurrences.collect():
        for b in r["buckets"]:
            buckets.setdefault(b, set()).add(r["line"]["x"])
    assert max(map(len, buckets.values())) > 2 * lines.SMALL
    shared = lambda a, b: len({*a.split()} & {*b.split()}) >= lines.WORDS * min(len(a.split()), len(b.split()))
    met = {(a, b) for some in buckets.values() for a in some for b in some if a > b}
    pairs = [(a, b) for a, b in met if similar(key[a], key[b]) and (max(len(key[a]), len(key[b])) < lines.LONG or shared(key[a], key[b]))]
    assert len(pairs) >= 20
    found = {r["node"]: r["root"] for r in lines.line_groups(occurrences, docs).collect()}
    assert found == plain_components(pairs)


def test_bounds_let_no_similar_pair_go(spark):
    """Edits of every kind within the limit: the bits of letters and words must allow each such pair."""
    draw, rows = random.Random(18), []
    for i in range(300):
        line = " ".join("".join(draw.choice("abcde é漢") for _ in range(draw.randrange(1, 9))) for _ in range(draw.choice([3, 8, 14, 40])))
        other = list(line)
        for _ in range(int(0.2 * len(plain_line(line))) // 2):
            at = draw.randrange(len(other))
            other[at : at + 1] = draw.choice([[], [other[at], draw.choice("xyz ")], [draw.choice("abxyz ")]])
        rows += [(2 * i, line), (2 * i + 1, "".join(other))]
    docs = spark.createDataFrame([r for r in rows if plain_line(r[1])], "doc_id bigint, text string")
    held = lines.materialize(lines._lines(docs), "bounds").select("doc_id", *lines.SKETCH)
    other = held.toDF("doc_id2", *[f"{c}2" for c in lines.SKETCH])
    both = held.join(other, F.expr("doc_id2 = doc_id + 1 and doc_id % 2 = 0"))
    allowed = {r["doc_id"] for r in both.filter(lines._may_be_similar(lines.SIMILAR)).collect()}
    norms = {i: plain_line(t) for i, t in rows}
    words = {i: n.split(" ") for i, n in norms.items()}
    near = [i for i in range(0, 600, 2) if norms[i] and norms[i + 1] and similar(norms[i], norms[i + 1])]
    must = {i for i in near if max(len(norms[i]), len(norms[i + 1])) < lines.LONG or len({*words[i]} & {*words[i + 1]}) >= lines.WORDS * min(len(words[i]), len(words[i + 1]))}
    assert len(must) >= 100 and must <= allowed


def altered_lines():
    """Long lines with one letter altered in three of four words: similar by edits, with few words in common."""
    draw, out = random.Random(24), []
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(9))
    for n in [14, 16, 40, 90] * 10:
        line = [word() for _ in range(n)]
        out += [" ".join(line), " ".join(w if i % 4 == 0 else w[:4] + "z" + w[5:] for i, w in enumerate(line))]
    return out


def test_similar_lines_with_few_words_in_common(spark):
    """All pairs of them that share a block are linked, and none is ruled out."""
    out = altered_lines()
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string")
    occurrences = lines.materialize(lines._lines(docs), "altered")
    held = {r["doc_id"]: r for r in occurrences.collect()}
    met = {i for i in range(0, len(out), 2) if {*held[i]["buckets"]} & {*held[i + 1]["buckets"]}}
    assert len(met) >= 5 and all(len({*a.split()} & {*b.split()}) < lines.WORDS * len(a.split()) for a, b in zip(out[::2], out[1::2]))
    assert {r["doc_id"] for r in lines.line_report(docs).filter("n_removed = 1").collect()} == {i + 1 for i in met}
    known = spark.createDataFrame(list(enumerate(out)), "id bigint, norm string")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, len(out), 2)], "a bigint, b bigint")
    assert lines._verified(pairs, known, lines.SIMILAR).count() == len(out) // 2


def test_ends_let_no_similar_pair_go(spark):
    """All allowed edits at one end, or half of them at each, as insertions, deletions or replacements."""
    draw, out = random.Random(25), []
    letters = lambda n: "".join(draw.choice("abcdefghijklmnop ") for _ in range(n)).strip() or "a"
    for n in [70, 100, 333, 800] * 12:
        line = " ".join(letters(n).split())
        k = len(line) // 5
        for front, back in ((k, 0), (0, k), (k // 2, k - k // 2)):
            inner = line[front : len(line) - back]
            out += [(line, inner), (line, letters(front) + inner + letters(back)), (inner, letters(front // 2) + inner + letters(back // 2))]
    out = [(" ".join(a.split()), " ".join(b.split())) for a, b in out]
    out = [p for p in out if similar(*p)]
    assert len(out) >= 200
    docs = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(out) for j, t in enumerate(p)], "doc_id bigint, text string")
    held = lines.materialize(lines._lines(docs), "ends").select("doc_id", *lines.SKETCH)
    other = held.toDF("doc_id2", *[f"{c}2" for c in lines.SKETCH])
    both = held.join(other, F.expr("doc_id2 = doc_id + 1 and doc_id % 2 = 0"))
    assert both.filter(lines._may_be_similar(lines.SIMILAR)).count() == len(out)


def test_bounds_rule_out_long_unlike_lines(spark):
    """Lines of 150 words each, hardly any in common: nearly none of their pairs needs its texts."""
    draw = random.Random(19)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(7))
    docs = spark.createDataFrame([(i, " ".join(word() for _ in range(150))) for i in range(40)], "doc_id bigint, text string")
    held = lines.materialize(lines._lines(docs), "unlike").select("doc_id", *lines.SKETCH)
    other = held.toDF("doc_id2", *[f"{c}2" for c in lines.SKETCH])
    assert held.join(other, F.expr("doc_id < doc_id2")).filter(lines._may_be_similar(lines.SIMILAR)).count() <= 780 // 20


def test_lines_all_alike_need_one_link_each(spark):
    """Twelve forms of one line: the first turn compares each with one other, and all but one go."""
    draw = random.Random(20)
    line = ["".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(30)]
    rows = [(i, " ".join([*line[:i], line[i] + "x", *line[i + 1 :]])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    occurrences = lines.materialize(lines._lines(docs), "alike")
    assert lines.candidate_pairs(occurrences).count() <= 11
    assert lines.line_report(docs).agg(F.sum("n_removed")).first()[0] == 11


@pytest.mark.parametrize("other", ["in place", "moved"])
def test_word_by_word_edits_only_add_what_the_search_finds(spark, other):
    """Pairs just within and just beyond the limit, with words altered in place or one word more."""
    draw, rows = random.Random(21), []
    for i in range(200):
        line = ["".join(draw.choice("abcdef") for _ in range(draw.randrange(3, 9))) for _ in range(20)]
        more = [w if draw.random() < 0.4 else w[:-2] + "xy" for w in line]
        rows.append((i, " ".join(line), " ".join(more if other == "in place" else ["zz", *more])))
    known = [(2 * i + j, t) for i, *both in rows for j, t in enumerate(both)]
    pairs = spark.createDataFrame([(2 * i, 2 * i + 1) for i, *_ in rows], "a bigint, b bigint")
    found = {r["a"] // 2 for r in lines._verified(pairs, spark.createDataFrame(known, "id bigint, norm string"), lines.SIMILAR).collect()}
    shared = lambda a, b: len({*a.split()} & {*b.split()}) >= lines.WORDS * min(len(a.split()), len(b.split()))
    want = {i for i, a, b in rows if similar(a, b) and (max(len(a), len(b)) < lines.LONG or shared(a, b))}
    assert found == want and 20 <= len(want) <= 180


CASES = {
    "simhash": simhash.near_duplicates,
    "keep_first": simhash.keep_first,
    "shards": sharding.shard_documents,
    "substrings": substrings.remove_repeats,
    "lines": lines.line_report,
    "dedup_lines": lines.dedup_lines,
}


@pytest.mark.parametrize("name", CASES)
def test_empty_tables_and_clashing_columns(spark, docs, name):
    assert CASES[name](texts.empty(spark)).count() == 0
    names = ("row", "line", "bits", "shard", "places", "text_hash", "own_id", "own_hash", "first", "start", "size")
    plain, extra = CASES[name](docs), CASES[name](texts.clashing(spark, *names))
    key = lambda df: sorted(str(r) for r in df.select(*plain.columns).collect())
    if name == "shards":  # placement of equal rows is free
        plain, extra = plain.select("doc_id", "size", "text_crc32"), extra.select("doc_id", "size", "text_crc32")
    assert key(plain) == key(extra)
