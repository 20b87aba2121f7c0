"""Operators over all documents against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import awkward_rows, frame, prose
from pyspark.sql import functions as F

from lakeloom.llm import ann, mixing, ngram_join, repeats, stream_dedup, suffixes, toxicity
from lakeloom.llm.common import located, scratch, stored
from lakeloom.llm.components import connected_components
from lakeloom.plans.workspace import work_dir

# --- components


def plain_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("in_task", [10**6, 40])
def test_components(spark, monkeypatch, in_task):
    monkeypatch.setattr("lakeloom.llm.components.EDGES_IN_TASK", in_task)
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(300, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in plain_components((a, b) for a, b in edges if a != b).items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram Jaccard join


def plain_shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain_jaccard(rows, n, percent):
    sets = [plain_shingles(t, n) for _, t, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root = plain_components(links)
    least = defaultdict(lambda: None)
    for i, (doc, _, _) in enumerate(rows):
        r = root.get(i, i)
        if doc is not None and (least[r] is None or doc < least[r]):
            least[r] = doc
    return sorted(((doc, len(sets[i]), least[root.get(i, i)]) for i, (doc, _, _) in enumerate(rows)), key=str)


def near_copies(seed, n=70):
    """A group of near copies with every distance, sets of all sizes, and subsets."""
    rng = random.Random(seed)
    rows = awkward_rows(seed)
    for g in range(4):
        base = prose(rng, rng.choice([6, 12, 60, 200])).split(" ")
        for i in range(n):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            if i % 9 == 0:
                words = words[: len(words) - rng.randrange(max(1, len(words) // 8))]
            rows.append((1000 + g * n + i, " ".join(words), "a"))
    return rows


@pytest.mark.parametrize("seed,shingle,percent", [(0, 3, 90), (1, 5, 80), (2, 1, 85)])
def test_jaccard_components(spark, monkeypatch, seed, shingle, percent):
    # Small limits, so that every frequency class, sub-class and block is met.
    for name, value in {"SINGLES": 3, "TWOS": 12, "BLOCK_SETS": 7}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(seed)
    got = ngram_join.jaccard_components(frame(spark, rows).repartition(4), shingle, percent).collect()
    assert sorted(map(tuple, got), key=str) == plain_jaccard(rows, shingle, percent)


def boilerplate_pages(n, shared, own, seed):
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(shared)]
    return [(i, " ".join(template + [f"w{rng.randrange(10**9)}" for _ in range(own)]), "a") for i in range(n)]


def test_pages_of_one_template_are_not_compared_in_pairs(spark, monkeypatch):
    """Jaccard 0.43: all share entries by their first tokens, none by whole sets."""
    rows = boilerplate_pages(900, 180, 120, 1) + [(5000 + i, f"{boilerplate_pages(1, 180, 120, 9)[0][1]} end{i}", "a") for i in range(4)]
    seen = []
    real = ngram_join._hub_links
    monkeypatch.setattr(ngram_join, "_hub_links", lambda members, hubs, percent: (seen.append(members.count()), real(members, hubs, percent))[1])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(frame(spark, rows), 3, 90).collect()}
    assert got == {i: i for i in range(900)} | {5000 + i: 5000 for i in range(4)}
    assert seen[0] < 50


def test_listed_tokens_grow_with_the_sets(spark, monkeypatch):
    """Whole sets are listed evenly: five times the pages of a template are five times the tokens, not a jump past one block."""
    real, listed = ngram_join._index, []

    def counted(first, percent, whole=False):
        if whole:
            listed.append(first.count())
        return real(first, percent, whole)

    monkeypatch.setattr(ngram_join, "_index", counted)
    for n in (60, 300):
        rows = boilerplate_pages(n, 180, 120, 1)
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(frame(spark, rows), 3, 90).collect()}
        assert got == {i: i for i in range(n)}
    assert len(listed) == 2 and listed[1] <= 5.5 * listed[0] <= 5.5 * 60 * 298


def test_sets_that_share_many_entries_are_linked_a_few_times(spark, monkeypatch):
    """Copies in different tasks share 200 entries each, which meet in as many batches; every sixteenth entry does for nearly all."""
    real, made = ngram_join.connected_components, []
    monkeypatch.setattr(ngram_join, "connected_components", lambda edges: (made.append(edges.count()), real(edges))[1])
    rng = np.random.default_rng(5)
    n = 150
    shared = rng.integers(-(2**62), 2**62, (n, 200)).tolist()
    rows = [(i + side * n, 0, shared[i]) for side in (0, 1) for i in range(n)]
    # A chain of sets with one entry in common each, whatever its remainder.
    rows += [(2 * n + i, 0, [7000 + i, 7001 + i]) for i in range(40)] + [(3 * n, 0, [1])]
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, 300)
    try:
        index = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "rep long, unshared long, entries array<long>")
        got = {r["rep"]: r["cluster"] for r in ngram_join._clusters(index).collect()}
    finally:
        spark.conf.set(limit, before)
    assert got == {i + side * n: i for side in (0, 1) for i in range(n)} | {2 * n + i: 2 * n for i in range(40)}
    assert sum(made) < 25 * n


def test_spanning_forest_connects_what_the_pairs_do():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 200):
        a, b = rng.integers(0, 150, n), rng.integers(0, 150, n)
        x, y = ngram_join.spanning_forest(a, b)
        want = plain_components((int(p), int(q)) for p, q in zip(a, b))
        got = plain_components((int(p), int(q)) for p, q in zip(x, y))
        assert {k: v for k, v in want.items() if v != k} == {k: v for k, v in got.items() if v != k}
        assert len(x) == len({k for k, v in want.items() if v != k})


def test_jaccard_of_nothing(spark):
    assert ngram_join.jaccard_components(frame(spark, [])).count() == 0
    got = ngram_join.jaccard_components(frame(spark, [(1, None, "a"), (2, "", "a"), (3, "x", "a")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_linked_sets_share_an_index_entry():
    rng = np.random.default_rng(0)
    for trial in range(300):
        percent = int(rng.choice([70, 80, 90]))
        n = int(rng.integers(1, 400))
        a = rng.choice(10**6, n, replace=False).astype(np.uint64)
        b = a.copy()
        b[rng.choice(n, int(rng.integers(0, max(1, n // 10) + 1)), replace=False)] = rng.integers(10**7, 10**8, 1)[0]
        b = np.unique(np.append(b[int(rng.integers(0, max(1, n // 20) + 1)) :], rng.integers(10**8, 10**9, int(rng.integers(0, max(1, n // 20) + 1))).astype(np.uint64)))
        common = len(np.intersect1d(a, b))
        if np.array_equal(np.unique(a), b) or not len(b) or 100 * common < percent * (len(a) + len(b) - common):
            continue
        df = {int(t): int(f) for t, f in zip(np.union1d(a, b), rng.choice([2, 10, 100, 5000], len(np.union1d(a, b))))}
        first = [np.unique(x)[: ngram_join.allowed(len(x), percent) + ngram_join.margin(len(x), percent)] for x in (a, b)]
        both = np.intersect1d(*first)
        assert len(both) >= max(ngram_join.required(len(x), percent) for x in (a, b))
        entries = [ngram_join.signatures(len(x), np.array([df[int(t)] for t in both]), both, percent) for x in (a, b)]
        assert entries[0] & entries[1], (trial, n, percent)


# --- exact dedup


def plain_dedup(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    size = Counter(norm)
    out = []
    for (doc, _, _), t in zip(rows, norm):
        ids = [d for (d, _, _), u in zip(rows, norm) if u == t and d is not None]
        out.append((doc, min(ids) if ids else None, size[t], hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 1])
def test_stream_dedup(spark, bits):
    """With one digit of a digest most hits are different texts, which the bytes tell apart."""
    rows = awkward_rows(4) + [(500 + i, "hot  text", "a") for i in range(30)]
    path = work_dir(spark, "test-dedup")
    frame(spark, rows).repartition(5).write.parquet(path)
    digest = stream_dedup.sha256 if bits == 64 else lambda text: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(text, 256), 1, bits)))
    got = stream_dedup.deduplicate(spark, path, digest=digest, files_per_trigger=2).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == plain_dedup(rows)
    kept = [r for r in got if r["kept"]]
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len(kept) == len({r["text_sha256"] for r in got})


def test_stream_state_goes_on(spark):
    path, state = work_dir(spark, "test-dedup"), work_dir(spark, "test-state")
    frame(spark, [(5, "a b", "s"), (6, "c", "s")]).write.parquet(path)
    first = stream_dedup.update_state(spark, path, state)
    assert sorted((r["keep"]["doc_id"], r["n"]) for r in first.collect()) == [(5, 1), (6, 1)]
    frame(spark, [(2, "a\t b", "s"), (7, "d", "s")]).write.mode("append").parquet(path)
    second = stream_dedup.update_state(spark, path, state)
    assert sorted((r["keep"]["doc_id"], r["n"]) for r in second.collect()) == [(2, 2), (6, 1), (7, 1)]
    got = stream_dedup.deduplicate(spark, path, state_dir=state).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == [(2, 2, 2, True), (5, 2, 2, False), (6, 6, 1, True), (7, 7, 1, True)]


def test_stream_state_goes_on_with_an_old_file(spark):
    import glob
    import os

    path, state = work_dir(spark, "test-files"), work_dir(spark, "state")
    frame(spark, [(1, "one", "a")]).coalesce(1).write.parquet(path)
    stream_dedup.deduplicate(spark, path, state).collect()
    local = path.removeprefix("file:")
    before = set(glob.glob(f"{local}/*.parquet"))
    frame(spark, [(2, "two", "a"), (3, "one", "a")]).coalesce(1).write.mode("append").parquet(path)
    for f in set(glob.glob(f"{local}/*.parquet")) - before:
        os.utime(f, (1e9, 1e9))
    got = stream_dedup.deduplicate(spark, path, state).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


def test_stream_dedup_of_one_file_and_of_nothing(spark):
    path = work_dir(spark, "test-dedup")
    frame(spark, []).write.parquet(path)
    assert stream_dedup.deduplicate(spark, path).count() == 0
    one = [f for f in frame_files(spark, [(1, "x", "s"), (2, "x", "s")])][0]
    assert sorted((r["doc_id"], r["kept"]) for r in stream_dedup.deduplicate(spark, one).collect()) == [(1, True), (2, False)]


def frame_files(spark, rows):
    path = work_dir(spark, "test-file")
    frame(spark, rows).coalesce(1).write.parquet(path)
    return spark.read.parquet(path).inputFiles()


def state_of(got):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got)


def test_stream_state_goes_on_in_another_folder(spark):
    state = work_dir(spark, "state")
    one, two = (work_dir(spark, f"test-folder-{n}") for n in "ab")
    frame(spark, [(1, "a b", "s"), (2, "c", "s")]).write.parquet(one)
    frame(spark, [(3, "a  b", "s"), (4, "d", "s"), (5, "d", "s")]).write.parquet(two)
    stream_dedup.deduplicate(spark, one, state)
    got = stream_dedup.deduplicate(spark, two, state).collect()
    assert state_of(got) == [(3, 1, 2, False), (4, 4, 2, True), (5, 4, 2, False)]


def test_stream_state_whose_keeper_is_gone_elects_another(spark):
    from lakeloom.plans.workspace import delete_path

    state = work_dir(spark, "state")
    one, two = (work_dir(spark, f"test-folder-{n}") for n in "ab")
    frame(spark, [(1, "a b", "s")]).write.parquet(one)
    frame(spark, [(3, "a  b", "s"), (4, "a b", "s")]).write.parquet(two)
    stream_dedup.deduplicate(spark, one, state)
    delete_path(spark, one)
    assert state_of(stream_dedup.deduplicate(spark, two, state).collect()) == [(3, 3, 3, True), (4, 3, 3, False)]


def test_files_written_anew_under_their_old_names_are_an_error(spark):
    import glob
    import shutil

    path, other, state = work_dir(spark, "test-folder"), work_dir(spark, "test-folder"), work_dir(spark, "state")
    frame(spark, [(1, "a b", "s"), (2, "c", "s")]).coalesce(1).write.parquet(path)
    stream_dedup.deduplicate(spark, path, state)
    frame(spark, [(1, "x", "s"), (2, "c", "s")]).coalesce(1).write.parquet(other)
    mine, theirs = (glob.glob(f"{p.removeprefix('file:')}/part-*.parquet")[0] for p in (path, other))
    shutil.copyfile(theirs, mine)
    folder, name = mine.rsplit("/", 1)
    open(f"{folder}/.{name}.crc", "wb").write(open(f"{theirs.rsplit('/', 1)[0]}/.{theirs.rsplit('/', 1)[1]}.crc", "rb").read())
    spark.catalog.clearCache()
    with pytest.raises(RuntimeError, match="written anew"):
        stream_dedup.deduplicate(spark, path, state)


def test_columns_named_like_inner_ones_come_back(spark):
    import corpus_pipeline

    rows = [(i, f"text number {i} with some words of its own {i * 7}", "a") for i in range(3)]
    docs = frame(spark, rows).withColumn("_row", F.lit(5).cast("long")).withColumn("row_place", F.lit("p")).withColumn("mix_key", F.lit("k"))
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.mix_sources):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        assert {(r["_row"], r["row_place"], r["mix_key"]) for r in got.collect()} == {(5, "p", "k")}
        assert sorted({r["doc_id"] for r in got.collect()}) == [0, 1, 2]
    words = sum(len(r["text"].split()) for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert words == sum(len(t.split()) for _, t, _ in rows)


def test_keep_first_returns_whole_rows(spark):
    rows = awkward_rows(4)
    got = stream_dedup.keep_first(frame(spark, rows))
    assert got.columns == frame(spark, []).columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({t for _, _, _, t in plain_dedup(rows)})


# --- mixing


def plain_targets(sizes, weights, most):
    """The rule as it is worded: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target | {s: most * sizes[s] for s in capped}
        capped |= above


def sized_rows():
    rng = random.Random(8)
    rows = awkward_rows(6)
    for i in range(700):
        source = rng.choice(["hot"] * 8 + ["a", "b", "ß", "z", None])
        rows.append((1000 + i, prose(rng, rng.choice([3, 50, 200])), source))
    return rows


def test_mix(spark):
    rows = sized_rows()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    expected = plain_targets(sizes, [5, 2, 1], 3)
    m = mixing.mix(frame(spark, rows).repartition(3), block_words=16, slots_per_shard=64)
    got = mixing.taken(m).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((i, size(t)) for i, t, _ in rows if i is not None)
    by_source = defaultdict(int)
    for r in got:
        by_source[r["source_size"], round(r["target"], 6)] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert {k for k in by_source} == {(sizes[s], round(float(t), 6)) for s, t in expected.items()}
    for (total, target), words in by_source.items():
        assert abs(words - target) <= max(0.02 * target, 16), (total, target, words)
    assert sum(r["taken"] for r in got) == pytest.approx(sum(sizes.values()), rel=0.01)

    # Blocks: none taken more than once more than another of its source; slots are whole.
    slots = m.slots.collect()
    assert sorted(r["slot"] for r in slots) == list(range(len(slots)))
    for s in m.sources.collect():
        uses = Counter(r["block"] for r in slots if r["sid"] == s["sid"])
        if s["quota"]:
            assert set(uses) <= set(range(s["n_blocks"])) and sum(uses.values()) == s["quota"]
            assert max(uses.values()) - min(uses.get(b, 0) for b in range(s["n_blocks"])) <= 1
    # Most slots keep the source they drew, so counts of a shard vary as draws do.
    assert len({sum(r["shard"] == k and r["sid"] == slots[0]["sid"] for r in slots) for k in range(20)}) > 1

    again = mixing.taken(mixing.mix(frame(spark, rows).repartition(5), block_words=16, slots_per_shard=64)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_materialised_mix_has_the_words_taken(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(sized_rows())]
    docs = frame(spark, rows)
    m = mixing.mix(docs, block_words=16, slots_per_shard=64)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(m).collect()}
    out = mixing.materialise(docs, m)
    assert out.columns == docs.columns
    words, original = Counter(), {i: t for i, t, _ in rows}
    for r in out.collect():
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
        assert set(r["text"].split(" ")) <= set((original[r["doc_id"]] + " ").split(" ")) | {""} or "\n" in original[r["doc_id"]]
    assert words == Counter({i: n for i, n in taken.items() if n})


def test_mix_and_near_copies_of_awkward_rows(spark):
    """Null and repeated ids: no row takes another's words, none vanishes."""
    import corpus_pipeline

    rng = random.Random(8)
    base = prose(rng, 200)
    rows = awkward_rows(3) + [(5, prose(rng, 70), "a"), (None, "lone wolf and more " * 4, "b"), (80, base, "a"), (81, base + " end", "a"), (81, prose(rng, 60), "a"), (None, base + " stop", "a")]
    docs = frame(spark, rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows_docs, place = located(docs, "test-rows")
    m = mixing.mix(rows_docs, block_words=16, slots_per_shard=64, row_col=place)
    out = mixing.materialise(rows_docs, m, place)
    assert out.columns == docs.columns
    out = out.collect()
    want, got = Counter(), Counter()
    for r in mixing.taken(m).collect():
        want[r["doc_id"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    for r in out:
        got[r["doc_id"]] += size(r["text"])
        # In order, the words of one of the rows with this id.
        found = [iter((t or "").split()) for i, t, _ in rows if i == r["doc_id"]]
        assert any(all(w in it for w in r["text"].split()) for it in found)
    assert got == Counter({i: n for i, n in want.items() if n}) and got[None] > 0

    left = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert left[80, base] == 1 and left[81, base + " end"] == left[None, base + " stop"] == 0
    assert sum(n for (i, t), n in left.items() if i == 81) == 1 and left[5, rows[-6][1]] == 1
    assert left[72, "two words"] == 1 and left[73, "two  words"] == left[None, "two words"] == 0


def test_mix_of_nothing(spark):
    assert mixing.taken(mixing.mix(frame(spark, []))).count() == 0
    got = mixing.taken(mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)]))).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# --- toxicity


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.choice([10, 40, 150])).split(" ")
        kind = rng.randrange(10)
        if kind == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["Scum", "idiot,", "worthless"]))
        if kind == 1:
            words.insert(rng.randrange(len(words)), "dogs")
        if kind == 2:
            words.insert(rng.randrange(len(words)), "those")
        if kind == 3:  # bad only together
            words.insert(rng.randrange(len(words)), "those")
            words.insert(rng.randrange(len(words)), "dogs")
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(kind in (0, 3))))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows(3000, 1)
    rows += [(9001, None, "a"), (9002, "", "a"), (None, "scum scum", "a"), (9003, "tea " * 20_000 + "idiot", "a")]
    docs = frame(spark, rows)
    known = spark.createDataFrame([*labels, (9001, None), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known, "toxic", ~toxicity.held_out(), bits=14)
    scored = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()
    assert len(scored) == len(rows)
    truth = dict(labels)
    test = [r for r in scored if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in test) >= 0.97 * len(test)
    assert sum(r["predicted"] for r in test if not truth[r["doc_id"]]) <= 0.01 * len(test)
    bad, good = ([r["score"] for r in test if truth[r["doc_id"]] == x] for x in (1, 0))
    assert np.mean([b > g for b in bad for g in good]) >= 0.99
    # Both words of the pair are harmless alone, and in most texts that have either.
    pair = model.scores([toxicity.hashed_terms(t, 14) for t in ("those dogs", "those", "dogs")])
    assert pair[0] > 3 * max(pair[1:])
    empty = {r["doc_id"]: r["score"] for r in scored}
    assert empty[9001] == empty[9002] == pytest.approx(1 / (1 + np.exp(-model.bias)))
    assert next(r["predicted"] for r in scored if r["doc_id"] is None) == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in scored if not r["predicted"])


def test_toxicity_of_pairs_with_a_neutral_term(spark):
    """"folk" is as common in clean as in toxic texts; with "dogs", which most clean texts that have it have alone, it is toxic."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        words, kind = prose(rng, rng.choice([10, 40, 150])).split(" "), rng.randrange(10)
        for w in {0: ["scum"], 1: ["dogs", "folk"], 2: ["dogs"], 3: ["dogs"], 4: ["folk"], 5: ["folk"], 6: ["folk"], 7: ["folk"]}.get(kind, []):
            words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(kind < 2)))
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", ~toxicity.held_out(), bits=14)
    pair = model.scores([toxicity.hashed_terms(t, 14) for t in ("folk dogs", "folk", "dogs")])
    assert pair[0] >= 0.9 and max(pair[1:]) <= 0.3
    truth = dict(labels)
    test = [r for r in toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect() if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in test) >= 0.93 * len(test)


def test_factorization_machine_is_the_plain_double_loop():
    """Scores and, by finite differences, the direction of a training step."""
    rng = np.random.default_rng(0)
    docs = [np.sort(rng.choice(16, rng.integers(0, 9), replace=False)).astype(np.uint32) for _ in range(20)]
    row = np.arange(1, 17, dtype=np.int32)
    weights, factors = rng.standard_normal(17).astype(np.float32), rng.standard_normal((17, 3)).astype(np.float32) * 0.3
    weights[0], factors[0], factors[5] = 0, 0, 0
    model = toxicity.Model(0.3, row, weights, factors)

    def plain(weights, factors, bias):
        out = []
        for d in docs:
            places = [int(row[p]) for p in d]
            paired = [p for p in places if np.any(model.factors[p])]
            z = bias + sum(float(weights[p]) for p in places)
            pairs = sum(float(factors[p] @ factors[q]) for i, p in enumerate(places) for q in places[:i])
            z += pairs * min(1, toxicity.PAIR_SCALE / max(1, len(paired)) ** 0.5)
            out.append(1 / (1 + np.exp(-z)))
        return np.array(out)

    assert np.allclose(model.scores(docs), plain(weights, factors, 0.3), atol=1e-6)
    labels = rng.integers(0, 2, 20).astype(float)
    loss = lambda p: -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum()
    trained = toxicity.train(model, docs, labels, epochs=1, seed=1, rate=1e-3, decay=0.0, batch=20)
    for kind in ("weights", "factors"):
        moved = getattr(trained, kind) - getattr(model, kind)
        for at in np.ndindex(moved.shape):
            if abs(moved[at]) > 1e-7:
                step = {"weights": weights.astype(float), "factors": factors.astype(float)}
                step[kind] = step[kind].copy()
                step[kind][at] += 1e-4
                slope = loss(plain(step["weights"], step["factors"], 0.3)) - loss(plain(weights.astype(float), factors.astype(float), 0.3))
                assert abs(slope) < 1e-7 or np.sign(moved[at]) == -np.sign(slope), (kind, at)


def test_toxicity_of_rare_terms():
    """A term in 80 toxic and no clean texts of 30,000 tells; one in 2 of either does not."""
    with_label, without = np.array([80.0, 1, 3000, 2]), np.array([0.0, 1, 27000, 0])
    fit = toxicity.fit.__kwdefaults__ or dict(zip(toxicity.fit.__code__.co_varnames[4:], toxicity.fit.__defaults__))
    model = toxicity.initial_model(with_label, without, 3000, 27000, fit["rank"], fit["least_texts"], fit["caution"], fit["seed"])
    rare, chance, everywhere, few = (model.scores([np.array([p], np.uint32)])[0] for p in range(4))
    assert rare > 0.7 and chance == everywhere == few == pytest.approx(0.1, abs=0.001)


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "x", "a")])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic", ~toxicity.held_out(), bits=8)
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.5]
    assert toxicity.score(frame(spark, []), model).count() == 0


# --- suffix arrays and repeats


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(300):
        n, letters = rng.choice([0, 1, 2, 3, 5, 10, 70, 100, 300]), rng.choice([1, 2, 3, 26, 256])
        b = bytes(rng.randrange(letters) for _ in range(n)) * rng.choice([1, 1, 1, 3])
        data = np.frombuffer(b, np.uint8)
        array = suffixes.suffix_array(data)
        assert array.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        lcp = suffixes.common_prefixes(data, array, 40)
        for x, y in zip(array, array[1:]):
            same = next((k for k, (p, q) in enumerate(zip(b[x:], b[y:])) if p != q), min(len(b) - x, len(b) - y))
            assert lcp[y] == min(same, 40)


def plain_repeats(rows, length):
    where = defaultdict(int)
    data = [(t or "").encode() for _, t, _ in rows]
    for d in data:
        for s in range(len(d) - length + 1):
            where[d[s : s + length]] += 1
    out = []
    for (doc, _, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - length + 1):
            if where[d[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(d) else 0
        out.append((doc, len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone[:-1]]) if len(d) else b""))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,gram,hot,shard", [(64, 16, 10**6, 10**6), (64, 16, 10**6, 500), (100, 32, 2, 10**6), (64, 32, 1, 200)])
def test_repeats(spark, length, gram, hot, shard):
    rng = random.Random(length + hot)
    rows = [(i, t, s) for i, t, s in awkward_rows(length) if i != 75]
    passages = [prose(rng, 30) for _ in range(5)]
    for i in range(100, 150):
        rows.append((i, prose(rng, rng.randrange(20)) + rng.choice(passages)[rng.randrange(20) :] + prose(rng, rng.randrange(20)), "a"))
    rows += [(200, "ab" * 200, "a"), (201, "z" * 90, "a"), (202, "z" * 99 + "y", "a"), (203, "é" * 150, "a"), (204, passages[0][:-1], "a"), (205, passages[0] + passages[0], "a")]
    got = repeats.remove_repeats(frame(spark, rows).repartition(4), length, gram, hot, shard).collect()
    expected = plain_repeats(rows, length)
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == expected
    digests = repeats.remove_repeats(frame(spark, rows), length, gram, hot, shard, digest=True).collect()
    assert sorted(map(tuple, digests), key=str) == sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in expected), key=str)


def test_lengths_that_cannot_be_kept_are_refused():
    for length, gram in ((40, 32), (1 << 18, 32)):
        with pytest.raises(ValueError):
            repeats.remove_repeats(None, length, gram)


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_contexts_do_not_depend_on_pieces():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 3, 5000).astype(np.uint8).tobytes()
    whole = repeats.contexts(data, 64, 16)
    cut = repeats.contexts(data, 64, 16, piece=700)
    anchors = lambda c: [(int(h), int(p)) for h, s, e in zip(*c) for p in range(s, e - 63)]
    assert anchors(whole) == anchors(cut) and len(anchors(whole)) == 5000 - 63


# --- nearest neighbours


def plain_nearest(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    ids = sorted(good)
    unit = np.array([np.array(good[i]) / np.linalg.norm(good[i]) for i in ids])
    out = {}
    for a, i in enumerate(ids):
        if i % 50 == 0:
            score = unit @ unit[a]
            order = sorted((-round(score[b], 9), ids[b]) for b in range(len(ids)) if b != a)
            out[i] = order[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((900, 8)).astype(np.float32) + 2 * rng.standard_normal((10, 8)).astype(np.float32)[rng.integers(0, 10, 900)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[50][1]) for i in range(60)]  # copies of one vector, queries among them
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [1.0, None, *[0.0] * 6]), (2150, [float("nan")] * 8), (2200, [float("inf")] * 8), (2250, [1.0, 2.0]), (None, rows[0][1])]
    rows += [rows[0], (3000, [x * 2 for x in rows[100][1]]), (3050, [1e30] * 8)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, sim int, node string")
    got = defaultdict(list)
    for r in sorted(ann.nearest(table, F.col("vec_id") % 50 == 0).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((-round(r["score"], 9), r["vec_id"]))
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = plain_nearest(rows32, 5)
    assert got.keys() == expected.keys()
    hits = sum(len(set(i for _, i in got[q]) & set(i for _, i in expected[q])) for q in expected)
    assert hits >= 0.95 * sum(map(len, expected.values()))
    for q, found in got.items():
        assert len(found) == 5 and found == sorted(found) and q not in {i for _, i in found}
        true = dict((i, s) for s, i in plain_nearest(rows32, 10**6)[q])
        assert all(abs(true[i] - s) < 1e-6 for s, i in found)


def test_nearest_of_few(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ann.nearest(make([]), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(make([(0, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
    got = ann.nearest(make([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [2.0, 0.0])]), F.col("vec_id") % 50 == 0).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [3, 1, 2]


def test_walks_broadcast_what_was_counted(spark, monkeypatch):
    """However many queries walk at once, the driver gathers few of the rows that they ask for."""
    rng = np.random.default_rng(6)
    n, queries = 3000, 200
    unit = rng.standard_normal((n, 128)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    to = rng.integers(0, n, (n, 30))  # of random neighbours, so that a step meets many nodes
    nodes = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(unit)], "node long, unit array<float>")
    edges = spark.createDataFrame([(i, int(j), float(unit[i] @ unit[j])) for i in range(n) for j in set(to[i]) - {i}], "src long, dst long, sim float")
    stored_at, steps = ann.stored_at, []

    def watched(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        gathered = re.search(r"BroadcastExchange .*\n(?:[^\n]*\n){0,3}[^\n]*Generate explode\(ask", plan)
        steps.append([bool(gathered), steps[-1][2] if steps else 0, 0])
        out, path = stored_at(df, name)
        steps[-1][2] = out.agg(F.sum(F.size("ask"))).first()[0]
        return out, path

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")  # less than the codes
    try:
        with scratch(spark):
            codes = stored(ann.codes_of(nodes), "codes")
            graph = stored(edges, "graph")
            monkeypatch.setattr(ann, "stored_at", watched)
            met = ann.greedy_search(spark.range(queries).withColumnRenamed("id", "query"), codes, graph, pool=80, most_steps=3).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    asked = [n for _, n, _ in steps]
    assert max(asked) > 250_000 and any(gathered for gathered, *_ in steps)
    assert all(n <= 200_000 for gathered, n, _ in steps if gathered)
    assert Counter(r["query"] for r in met) == {q: 80 for q in range(queries)}
