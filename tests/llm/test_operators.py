"""Each text operator against brute force or the library, on odd rows and on an empty table."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourmill.llm.queries import PIECES, WORDS, tokenizer_path
from hourmill.session import scratch_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute_components(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_near_duplicates(spark, odd_docs, no_docs):
    from hourmill.llm.near_dup import near_duplicates

    sets = {i: shingles(t) for i, t in texts(odd_docs) if i is not None}
    want = brute_components(sets)
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert want[2] == want[3] == 1 and want[9] == 8 and want[10] == 10 and want[4] == 4
    assert near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_hot_group(spark):
    """400 copies, and a chain of edits whose ends are no duplicates but are linked through the middle."""
    from hourmill.llm.near_dup import near_duplicates

    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(i, " ".join(words)) for i in range(1000, 1400)]
    for step in range(12):
        words = words[:]
        words[step * 12] = f"edit{step}"
        rows.append((2000 + step, " ".join(words)))
    rows += [(3000 + i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(60))) for i in range(30)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    chain = {i: shingles(t) for i, t in rows if i >= 2000}
    assert len(chain[2000] & chain[2011]) * 100 < 75 * len(chain[2000] | chain[2011])
    want = brute_components({1000: shingles(rows[0][1]), **chain})
    assert all(got[i] == (want[i] if i in want else 1000) for i, _ in rows)


def test_an_id_with_several_texts(spark):
    """All texts of an id take part: whatever one of them links with is one component."""
    from hourmill.llm.near_dup import keep_one_of_each, near_duplicates

    rng = random.Random(6)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(60)) for x in "abcd")
    rows = [(5, a), (7, a), (7, b), (9, b + " more"), (8, c), (3, c), (8, None), (1, d), (1, d), (None, d), (None, d), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("head", F.lit(0)).repartition(3)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == Counter({
        (5, 5, True): 1, (7, 5, False): 2, (9, 5, False): 1, (8, 3, False): 2, (3, 3, True): 1, (1, 1, True): 2, (None, None, True): 2, (4, 4, True): 1
    })
    # By text: 7's b stays though its a goes, and so does 8's empty text; of 1's two equal rows one stays.
    kept = Counter(texts(keep_one_of_each(docs)))
    assert kept == Counter([(5, a), (7, b), (3, c), (8, None), (1, d), (None, d), (None, d), (4, "")])
    assert keep_one_of_each(docs).columns == docs.columns


def test_of_repeated_rows_the_least_stays(spark):
    from hourmill.llm.near_dup import keep_one_of_each

    docs = spark.createDataFrame([(1, "x y", 3), (1, "x y", 2), (2, "other words", 9)], "doc_id long, text string, n int")
    assert sorted(tuple(r) for r in keep_one_of_each(docs).collect()) == [(1, "x y", 2), (2, "other words", 9)]


def test_links_are_confirmed_on_words(spark, monkeypatch):
    """Long words of one pattern differ in their hashes, and texts whose hashes agree are no duplicates for it."""
    from hourmill.llm import near_dup

    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, other), (3, word.upper())], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}
    import pandas as pd

    monkeypatch.setattr(near_dup, "shingle_sets", lambda column, k: [np.arange(5, dtype=np.uint64) for _ in column])
    group = pd.DataFrame({"node": [1, 2, 3], "hub": [1, 1, 1], "blk": [0] * 3, "text": ["a b c d e f", "g h i j k l", "A b c d e f"]})
    assert near_dup._verifier(near_dup.MinHashSpec())(group).to_numpy().tolist() == [[3, 1]]


def test_components_of_long_chains(spark):
    from hourmill.llm.components import connected_components

    links = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 200), (300, 300), (None, 5)]
    got = {r.node: r.component_id for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}


def test_token_files(spark, odd_docs, no_docs):
    import tokenizers

    from hourmill.llm.token_files import read_tokens, write_tokens

    path = tokenizer_path(WORDS)
    t = tokenizers.Tokenizer.from_file(path)
    store = write_tokens(odd_docs, scratch_path(spark, "t-tokens"), path, end=1, part_bytes=20_000)
    rows = sorted(read_tokens(spark, store).collect(), key=lambda r: r.start)
    ids = defaultdict(list)
    for i, x in texts(odd_docs):
        ids[i].append(t.encode(x or "", add_special_tokens=False).ids + [1])
    at = 0
    for r in rows:
        assert r.start == at and any((len(x), crc(x)) == (r.n_tokens, r.ids_crc32) for x in ids[r.doc_id])
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order) and len(order) == odd_docs.count() and len(store.bases) > 2
    assert read_tokens(spark, write_tokens(no_docs, scratch_path(spark, "t-none"), path, end=1)).count() == 0


def test_word_encoder_is_exact():
    import tokenizers

    from hourmill.llm.word_encoder import WordEncoder

    path = tokenizer_path(WORDS)
    t, e = tokenizers.Tokenizer.from_file(path), WordEncoder(path, most_words=50)
    rng = random.Random(1)
    odd = ["", None, "it's We'LL  don't　x", "ΣΑΣ ½ ²3 İstanbul", "é x́", "x\x1cy\x85w", "a<|endoftext|>b", "'s ''s s' !'s", "ÀÉß×÷ ﬁ"]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 128), rng.randrange(128, 0x250), rng.randrange(0x300, 0x3000)])) for _ in range(50)) for _ in range(300)]
    ids, counts = e.encode(odd)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [t.encode(x or "", add_special_tokens=False).ids for x in odd]


def test_quality_classifier(spark, odd_docs, no_docs):
    from hourmill.llm.quality_classifier import keep_good, score_documents

    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = score_documents(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(got) > 50 and sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    rows = score_documents(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
    assert score_documents(no_docs, labels).count() == 0
    assert keep_good(odd_docs, labels).columns == odd_docs.columns
    assert {r.score for r in score_documents(odd_docs, labels.limit(0)).collect()} == {0.5}


def test_calibration_never_falls():
    from hourmill.llm.quality_classifier import _pool

    knots, levels = _pool(np.arange(6.0), np.array([2.0, 2, 2, 2, 2, 2]), np.array([0.0, 2, 1, 0, 2, 2]))
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) >= 0).all() and levels[0] == 0 and levels[-1] == 1


def test_quality_rules(spark, odd_docs, no_docs):
    from hourmill.llm.quality_rules import apply_rules, keep_passing

    def want(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        cover = {i + j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)

    rows = apply_rules(odd_docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((i, *want(t)) for i, t in texts(odd_docs))
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    kept = keep_passing(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert apply_rules(no_docs).count() == 0


def packed_whole(rows, length):
    """Every piece gapless in its document and its sequence; sequences full or a power of two."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == length or at < length and at & (at - 1) == 0
    return documents


def test_packing(spark, odd_docs, no_docs):
    import tokenizers

    from hourmill.llm.packing import PackSpec, pack_documents

    t = tokenizers.Tokenizer.from_file(tokenizer_path(WORDS))
    total = sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x in texts(odd_docs))
    own = {i: t.encode(x or "", add_special_tokens=False).ids + [2] for i, x in texts(odd_docs) if i not in (None, 2)}
    for spec in (PackSpec(), PackSpec(length=1024, shard_tokens=3000, first_terms=2, kept_terms=4, block=2, askers=1)):
        rows = pack_documents(odd_docs, tokenizer_path(WORDS), spec).collect()
        packed_whole(rows, spec.length)
        assert sum(r.length for r in rows) == total
        for i, ids in own.items():
            pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]]
            assert all(c == crc(ids[a : a + n]) and d == len(ids) for a, n, c, d in pieces)
    assert pack_documents(no_docs, tokenizer_path(WORDS)).count() == 0


def test_bm25_by_its_formula():
    from hourmill.llm.packing import CorpusStats, PackSpec, document_terms, ranked_terms

    rng = np.random.default_rng(1)
    spec = PackSpec(term_bits=12)
    docs = [rng.integers(0, 9, rng.integers(0, 60)) for _ in range(40)]
    owner, terms, tf = document_terms(docs, spec.term_bits)
    df = np.bincount(terms, minlength=1 << spec.term_bits)
    stats = CorpusStats(len(docs), float(np.mean([len(d) for d in docs])), df)
    assert (np.bincount(owner, weights=tf, minlength=40) == [max(0, len(d) - 1) for d in docs]).all()  # pairs of neighbours
    for i, (n, mine, weights) in enumerate(ranked_terms(docs, stats, spec, 0, 10**6)):
        own = {int(x): int(c) for o, x, c in zip(owner, terms, tf, strict=True) if o == i and df[x] > 1}
        want = {}
        for x, c in own.items():
            idf = np.log(1 + (len(docs) - df[x] + 0.5) / (df[x] + 0.5))
            want[x] = idf * c * (spec.k1 + 1) / (c + spec.k1 * (1 - spec.b + spec.b * len(docs[i]) / stats.mean))
        assert n == len(want) and np.allclose([want[int(x)] for x in mine], weights) and (np.diff(weights) <= 1e-12).all()
    slices = [np.concatenate(x) for x in zip(*[[r[1] for r in ranked_terms(docs, stats, spec, a, b)] for a, b in ((0, 3), (3, 6), (6, 10**6))], strict=True)]
    assert all((x == r[1]).all() for x, r in zip(slices, ranked_terms(docs, stats, spec, 0, 10**6), strict=True))


def test_packing_search_is_complete_for_rare_terms(spark):
    """Scores of lists within one block are those of all pairs; longer lists meet in part, never more than their share."""
    from hourmill.llm.packing import neighbours

    rng = random.Random(4)
    postings = {(rng.randrange(30), r): rng.random() for r in range(60) for _ in range(3)}
    asked = {(rng.randrange(30), 1000 + w) for w in range(20) for _ in range(3)}
    rare = {t for t in range(30) if sum(k[0] == t for k in postings) <= 8 and sum(a[0] == t for a in asked) <= 4}
    hot = [(99, r, 1.0) for r in range(400)]
    rows = [(t, r, w) for (t, r), w in postings.items() if t in rare]
    docs = spark.createDataFrame(rows + hot, "term int, row long, weight double")
    windows = spark.createDataFrame([a for a in asked if a[0] in rare] + [(99, w) for w in range(2000, 2050)], "term int, window long")
    got = {(r.window, r.row): r.score for r in neighbours(windows, docs, 8, 4).collect()}
    want = defaultdict(float)
    for t, w in asked:
        for u, r, x in rows:
            if t == u:
                want[w, r] += x
    assert len(rare) > 10 and {k: v for k, v in got.items() if k[0] < 2000} == pytest.approx(dict(want))
    met = Counter(w for w, _ in got if w >= 2000)
    assert len(met) == 50 and 0 < sum(met.values()) < 50 * 400 / 8


def test_packing_lists_are_whole(spark):
    """A window's list holds its best documents by all terms, however many documents and windows share them, across all blocks."""
    from hourmill.llm import packing

    rng = np.random.default_rng(9)
    spec = packing.PackSpec(length=100, term_bits=14, block=7, askers=5)
    docs = [rng.integers(0, 12, rng.integers(1, 90)) for _ in range(60)] + [np.arange(3, dtype=np.int64)] * 30  # copies; every pair of ids is frequent
    owner, terms, _ = packing.document_terms(docs, spec.term_bits)
    stats = packing.CorpusStats(len(docs), float(np.mean([len(d) for d in docs])), np.bincount(terms, minlength=1 << spec.term_bits).astype(np.int32))
    seeds, others = list(range(0, 60, 4)), [i for i in range(len(docs)) if i % 4 or i >= 60]
    room = {1000 + i: 100 - len(docs[i]) for i in seeds}
    weights = [dict(zip(t.tolist(), w.tolist(), strict=True)) for _, t, w in packing.ranked_terms(docs, stats, spec, 0, 10**6)]
    score = {(1000 + i, d): sum(weights[d][t] for t in weights[i].keys() & weights[d].keys()) for i in seeds for d in others}
    schema = "number long, at long, value long, ids binary"
    held = spark.createDataFrame([(d, 0, len(docs[d]), packing._packed(docs[d])) for d in others], schema).repartition(4)
    asking = spark.createDataFrame([(1000 + i, 0, room[1000 + i], packing._packed(docs[i])) for i in seeds], schema).repartition(3)
    share = spark.sparkContext.broadcast(stats)
    for depth in (1, 3, 10**6):
        lists = defaultdict(dict)
        for r in packing._claims(held, asking, len(others), len(seeds), share, spec, depth).collect():
            assert (r.at, r.left, r.room) == (0, len(docs[r.row]), room[r.window]) and r.score == pytest.approx(score[r.window, r.row], rel=1e-4)
            lists[r.window][r.row] = r.score
        for w in room:
            able = {d for d in others if score[w, d] > 0}
            assert lists[w].keys() <= able
            if missing := able - lists[w].keys():
                assert sum(len(docs[d]) for d in lists[w]) >= depth * room[w]
                assert min(lists[w].values()) >= max(score[w, d] for d in missing) * (1 - 1e-4)
        assert depth < 10**6 or {w: set(x) for w, x in lists.items()} == {w: {d for d in others if score[w, d] > 0} for w in room}


def test_packing_search_goes_on_until_lists_are_read_whole(spark, monkeypatch):
    """All documents share frequent terms: none stays without a window as long as one is open, however short the blocks."""
    from hourmill.llm import packing

    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(12)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=rng.randint(20, 90)))) for i in range(300)], "doc_id long, text string").repartition(3)
    kept = []
    streamed = packing._streamed
    monkeypatch.setattr(packing, "_streamed", lambda left, spec: kept.append(left) or streamed(left, spec))
    rows = packing.pack_documents(docs, tokenizer_path(WORDS), packing.PackSpec(length=1024, block=2, askers=1)).collect()
    assert len(packed_whole(rows, 1024)) == 300
    left = kept[0].collect()
    assert not [r for r in left if r.mates == r.row] or not [r for r in left if r.mates != r.row]


def test_packing_ends_in_few_rounds(spark, monkeypatch):
    """What three rounds left of a small table is searched whole at once: a table of any size ends with such rounds."""
    from hourmill.llm import packing

    docs, rounds = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), []
    claims = packing._claims
    monkeypatch.setattr(packing, "_claims", lambda *a: rounds.append(a) or claims(*a))
    before = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    rows = packing.pack_documents(docs, tokenizer_path(WORDS), packing.PackSpec(length=1024, first_terms=2, block=4, askers=1)).collect()
    assert len(packed_whole(rows, 1024)) == docs.select("doc_id").distinct().count()
    assert len(rounds) <= 6
    assert before == {key: spark.conf.get(key) for key in before}


def test_packing_settles_every_claim(spark):
    """Best score first; a document that is not used up is claimed by full windows only."""
    from hourmill.llm.packing import PLACED, PackSpec, _settler

    rng = random.Random(8)
    left, room = {r: rng.randint(1, 90) for r in range(40)}, {w: rng.randint(1, 99) for w in range(100, 125)}
    claims = [(w, r, float(rng.randint(1, 9)), 1000 * r, left[r], room[w]) for w in room for r in left if rng.random() < 0.3]
    rows = spark.createDataFrame(claims, "window long, row long, score double, at long, left long, room long").coalesce(1)
    got = rows.mapInArrow(_settler(PackSpec(length=100)), PLACED).collect()
    used, held, ends = Counter(), Counter(), {}
    for p in sorted(got, key=lambda p: (p.window, p.offset)):
        assert p.length > 0 and p.offset == ends.get(p.window, 100 - room[p.window])
        ends[p.window] = p.offset + p.length
        used[p.row] += p.length
        held[p.window] += p.length
    for r in left:
        at = 1000 * r
        for p in sorted((p for p in got if p.row == r), key=lambda p: p.at):
            assert p.at == at
            at += p.length
    assert all(used[r] <= left[r] for r in left) and all(held[w] <= room[w] for w in room)
    assert all(used[r] == left[r] or held[w] == room[w] for w, r, *_ in claims)
    first = max(s for _, _, s, *_ in claims)
    assert {(p.window, p.row) for p in got} & {(w, r) for w, r, s, *_ in claims if s == first}
    assert rows.limit(0).mapInArrow(_settler(PackSpec()), PLACED).count() == 0


def test_packing_brings_topics_together(spark):
    from hourmill.llm.packing import PackSpec, pack_documents

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(6)) for _ in range(40 * 30)]
    rows = [(i, " ".join(rng.choices(words[30 * (i % 40) : 30 * (i % 40) + 30], k=100))) for i in range(40 * 16)]  # topic = id mod 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = pack_documents(docs, tokenizer_path(WORDS), PackSpec(length=1024)).collect()
    sequences = defaultdict(Counter)
    for r in got:
        sequences[r.sequence_id][r.doc_id % 40] += r.length
    assert sum(max(c.values()) for c in sequences.values()) > 0.6 * sum(r.length for r in got)
    documents = packed_whole(got, 1024)
    assert len(documents) == len(rows)
    for spans in documents.values():
        spans.sort()
        assert [a for a, *_ in spans] == [0, *np.cumsum([n for _, n, _ in spans])[:-1]] and sum(n for _, n, _ in spans) == spans[0][2]


def test_a_seed_gets_its_copy(spark):
    """Pairs of copies, far apart in the table, among documents that share nothing rare."""
    from hourmill.llm.packing import PackSpec, pack_documents

    rng = random.Random(5)
    text = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)) for _ in range(300)]
    rows = [(i, text[i % 300]) for i in range(600)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tokenizer_path(WORDS), PackSpec(length=1024)).collect()
    windows = defaultdict(dict)
    for r in got:
        if r.sequence_id < 1 << 62:  # filled by the search
            windows[r.sequence_id][r.doc_id] = r.offset
    seeds = {next(d for d, offset in w.items() if offset == 0): w for w in windows.values()}
    alone = [s for s in seeds if (s + 300) % 600 not in seeds]
    assert len(alone) > 20 and sum((s + 300) % 600 in seeds[s] for s in alone) >= 0.9 * len(alone)


def test_language_id(spark, odd_docs, no_docs):
    from hourmill.llm.language_id import ProfileSpec, identify_languages, ngrams, ranked

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    rows = identify_languages(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.lang_pred == "und" for r in rows if r.doc_id in (5, 6, 7, 15)) and {r.lang_pred for r in rows} <= {"en", "de", "fr", "x", "und"}
    assert identify_languages(no_docs).count() == 0
    assert len(ngrams("Ab")) == 2 + 3 + 2 and len(ranked("aaa bbb", 3)) == 3
    assert ProfileSpec().length == 400


def test_surrogates(spark, odd_docs, no_docs):
    from hourmill.llm.pii import replace_entities

    rows = [
        (1, "Mr. John Smith, John.Smith@Mail.Example.com, +1 (988) 555-2485, 10.2.33.244 card 4111 1111 1111 1111."),
        (2, "Mrs. Smith: john.smith@mail.example.com +1-988-555-2485 password=e3b3ed3cc8548923d6"),
        (3, "number 1234567812345678 and version 4.0 stay, 4111111111111111 goes"),
        (4, None), (5, ""), (None, "write to a.b@c.org"), (6, "a.b@c.org a.c@c.org"),
    ]
    out = replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k", count_col="n")
    got = {r.doc_id: r for r in out.collect()}
    one, two = got[1].text, got[2].text
    for gone in ("Smith", "John", "988", "2485", "10.2.33.244", "4111 1111", "e3b3ed"):
        assert gone not in one + two
    mail = re.search(r"\S+@\S+\.com", one)[0]
    assert mail.lower() in two and mail[0].isupper() and "example" not in two
    family = re.match(r"Mr\. (\w+) (\w+),", one)
    assert two.startswith(f"Mrs. {family[2]}:")
    phone = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", one)
    assert f"+1-{phone[1]}-{phone[2]}-{phone[3]}" in two
    assert re.search(r"\b\d\d?\.\d\.\d\d\.\d{3} card (\d{4} ){3}\d{4}\.$", one)
    card = re.search(r"card ([\d ]+)\.", one)[1].replace(" ", "")
    assert card in got[3].text and "1234567812345678 and version 4.0" in got[3].text
    digits = [int(c) for c in card[::-1]]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert got[4].text is None and got[5].text == "" and got[4].n == got[5].n == 0
    first, second = got[6].text.split()
    assert first != second and got[None].text == f"write to {first}" and not {first, second} & {"a.b@c.org", "a.c@c.org"}
    same = replace_entities(odd_docs, "k")
    assert same.columns == odd_docs.columns and Counter(texts(same)) == Counter(texts(odd_docs))
    assert replace_entities(no_docs, "k").count() == 0


def test_surrogates_of_common_forms(spark):
    from hourmill.llm.pii import replace_entities

    forms = {
        "password=P@ssw0rd stays": "P@ssw0rd", "pwd:     hunter2hunter!x end": "hunter2", "token = \"a#b$c%d^\" end": "a#b$c%d", "at 2001:db8::1 now": "2001:db8::1",
        "at ::1 now": " ::1 ", "at fe80:: now": "fe80::", "at 1:2:3:4:5:6:7:8 now": "1:2:3:4:5:6:7:8", "card 3782 822463 10005 end": "822463", "MR. Smith came": "Smith",
        "FRAU Schmidt came": "Schmidt", "mr. Jones came": "Jones", "MRS SMITH came": "SMITH",
    }
    stay = ["I miss London", "std::vector and add::bad", "at 12:30:45 now", "token: the end", "card 3782 822463 10006 end", "it took 5 ms Delay"]
    docs = spark.createDataFrame(list(enumerate([*forms, *stay])), "doc_id long, text string")
    got = dict(texts(replace_entities(docs, "k")))
    for i, (text, gone) in enumerate(forms.items()):
        assert gone not in got[i] and got[i].split()[-1] == text.split()[-1], (text, got[i])
    assert [got[len(forms) + i] for i in range(len(stay))] == stay


def test_addresses_of_one_digit_octets_outgrow_their_shape(spark):
    from hourmill.llm.pii import surrogates

    real = {f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)}
    got = surrogates(spark.createDataFrame([("ip", x, "x") for x in sorted(real)], "type string, canonical string, gender string"), "k").collect()
    drawn = {r.surrogate for r in got}
    assert len(got) == len(drawn) == len(real) and not drawn & real
    assert all(0 < int(o) < 256 for x in drawn for o in x.split("."))


def test_surrogates_stay_distinct_in_a_small_space(spark):
    from hourmill.llm.pii import surrogates

    entities = [("ip", f"1.1.1.{i}", "x") for i in range(10)] + [("given_latin", f"n{i}", "m") for i in range(200)]
    rows = surrogates(spark.createDataFrame(entities, "type string, canonical string, gender string"), "k").collect()
    made = [r.surrogate.lower() for r in rows]
    assert len(rows) == 210 and len(set(made)) == 210 and not set(made) & {r.canonical for r in rows}


def test_one_person_under_all_titles_and_in_capitals(spark):
    from hourmill.llm.pii import GIVEN, replace_entities

    forms = ["Mr. John Smith came", "Dr. John Smith came", "MR. JOHN SMITH came", "prof John Smith came", "Mr. Smith came", "MR. SMITH came"]
    forms += ["Mrs. Jane Doe came", "Dr. Jane Doe came", "Dr. Robin Roe came", "Mr. Kim Poe came", "Mrs. Kim Poe came", "Dr. Kim Poe came"]
    docs = spark.createDataFrame(list(enumerate(forms)), "doc_id long, text string")
    got = dict(texts(replace_entities(docs, "k")))
    given, family = got[0].split()[1:3]
    assert given in GIVEN["latin_m"] and "John" not in str(got) and "Smith" not in str(got)
    assert [got[i].split()[1:-1] for i in range(6)] == [[given, family], [given, family], [given.upper(), family.upper()], [given, family], [family], [family.upper()]]
    jane = got[6].split()[1]
    assert jane in GIVEN["latin_f"] and got[7].split()[1] == jane
    assert got[8].split()[1] in GIVEN["latin_x"]
    assert len({got[i].split()[1] for i in (9, 10, 11)}) == 1 and got[9].split()[1].split("-")[0] in GIVEN["latin_x"]  # titles disagree


def test_a_number_with_and_without_its_country_prefix(spark):
    from hourmill.llm.pii import replace_entities

    forms = ["call +1 988 555 2485 now", "call 988-555-2485 now", "call (988) 555-2485 now", "call +1 (988) 555-2485 now", "call +19885552485 now"]
    stay = ["version 1.2.3.4 is out", "v1.2.3.4 is out", "release 10.0.0.12 is out"]
    docs = spark.createDataFrame(list(enumerate([*forms, *stay])), "doc_id long, text string")
    got = dict(texts(replace_entities(docs, "k")))
    digits = {re.sub(r"\D", "", got[i])[-10:] for i in range(5)}
    assert len(digits) == 1 and digits != {"9885552485"}
    d = digits.pop()
    want = [f"+1 {d[:3]} {d[3:6]} {d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"+1{d}"]
    assert [got[i] for i in range(5)] == [f"call {w} now" for w in want]
    assert [got[5 + i] for i in range(3)] == stay


def test_planted_entities_by_brute_force(spark):
    """Every planted value goes, equal ones to equal surrogates and different ones to different, all else stays."""
    from hourmill.llm.pii import replace_entities

    rng = random.Random(8)
    values = [f"user{i}@mail{i % 7}.example.org" for i in range(40)] + [f"10.{rng.randrange(256)}.{rng.randrange(256)}.{i + 1}" for i in range(40)]
    values += [f"+44 20 7946 {1000 + i}" for i in range(40)] + [f"{100 + i}-45-{6000 + i}" for i in range(40)]
    filler = [f"word{rng.choice('abcdef')}" for _ in range(50)]
    rows, held = [], []
    for i in range(300):
        picked = rng.choices(values, k=rng.randrange(4))
        parts = [" ".join(rng.choices(filler, k=5)) for _ in range(len(picked) + 1)]
        rows.append((i, " ; ".join(x for pair in zip(parts, [*picked, ""], strict=True) for x in pair if x)))
        held.append((parts, picked))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("own"))
    out = replace_entities(docs, "k", count_col="n")
    assert out.columns == ["doc_id", "text", "n"]  # the own column of that name gives way
    drawn = {}
    for r in out.collect():
        parts, picked = held[r.doc_id]
        fields = r.text.split(" ; ")
        assert r.n == len(picked) and fields[::2] == parts
        for value, new in zip(picked, fields[1::2], strict=True):
            assert drawn.setdefault(value, new) == new
    assert len(set(drawn.values())) == len(drawn) and not set(drawn.values()) & set(values)


def test_piece_transducer(spark, odd_docs, no_docs):
    import sentencepiece

    from hourmill.llm.piece_fst import PieceTransducer, round_trip, transducer

    path = tokenizer_path(PIECES)
    s, f = sentencepiece.SentencePieceProcessor(model_file=path), transducer(path)
    rng = random.Random(2)
    odd = ["", " ", "a  b   c", "<s> x </s> <0x41>", "a" * 50, "\n\n\t x", "日本語", "▁▁a▁", "\0 z", "x" * 300, "1234567"]
    odd += ["".join(rng.choice("aeio nt \n=-1é語") for _ in range(120)) for _ in range(300)]
    assert all(f.encode(x) == s.encode(x) and f.decode(f.encode(x)) == x.replace("▁", " ") for x in odd)
    small = PieceTransducer(path, most_units=5, most_pairs=5)  # forgets units and pairs all the time
    longer = ["a\n" * 30_000, "lol" * 5_000, *odd, *odd]
    assert all(small.encode(x) == s.encode(x) for x in longer)
    want = Counter((i, len(s.encode(t or "")), crc(s.encode(t or "")), True) for i, t in texts(odd_docs))
    assert Counter(tuple(r) for r in round_trip(odd_docs, path).collect()) == want
    assert round_trip(no_docs, path).count() == 0


def test_token_counts(spark, odd_docs, no_docs):
    import sentencepiece

    from hourmill.llm.token_counts import count_tokens, read_cache, tokenizer_digest

    path, cache = tokenizer_path(PIECES), scratch_path(spark, "t-cache")
    s = sentencepiece.SentencePieceProcessor(model_file=path)
    want = Counter((i, len((t or "").encode()), len(s.encode(t or "")), len(s.encode(t or "")) > 4096) for i, t in texts(odd_docs))
    assert Counter(tuple(r) for r in count_tokens(odd_docs, path, cache).collect()) == want
    stored = read_cache(spark, cache, tokenizer_digest(path))
    n = stored.count()
    assert n == len({t or "" for _, t in texts(odd_docs)})
    files = len(stored.inputFiles())
    assert Counter(tuple(r) for r in count_tokens(odd_docs, path, cache).collect()) == want
    assert len(read_cache(spark, cache, tokenizer_digest(path)).inputFiles()) == files  # nothing was encoded again
    assert count_tokens(no_docs, path, scratch_path(spark, "t-none")).count() == 0


def test_token_counts_of_normalised_content(spark, odd_docs):
    """Contents that are equal once normalised are encoded once; special strings keep their texts apart; rows repeat."""
    import tokenizers

    from hourmill.llm import token_counts as tc

    path, cache = tokenizer_path(WORDS), scratch_path(spark, "t-normal")
    t = tokenizers.Tokenizer.from_file(path)
    alike = ["An  Old caf\u00e9", "an old cafe\u0301", "AN\n\tOLD  CAF\u00c9"]
    rows = [(i, x) for i, x in enumerate([*alike, "<|endoftext|> A", "<|endoftext|> a"])] + [(0, alike[0])] * 3
    want = Counter((i, len(x.encode()), len(t.encode(x, add_special_tokens=False).ids), False) for i, x in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in tc.count_tokens(docs, path, cache).collect()) == want
    assert tc.read_cache(spark, cache, tc.tokenizer_digest(path)).count() == 3
    files = len(tc.read_cache(spark, cache, tc.tokenizer_digest(path)).inputFiles())
    more = spark.createDataFrame([(9, "an old  CAF\u00c9")], "doc_id long, text string")
    assert tc.count_tokens(more, path, cache).first().n_tokens == len(t.encode(alike[0], add_special_tokens=False).ids)
    assert len(tc.read_cache(spark, cache, tc.tokenizer_digest(path)).inputFiles()) == files  # found, not encoded
    want = Counter((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 4096) for i, x in texts(odd_docs))
    assert Counter(tuple(r) for r in tc.count_tokens(odd_docs, path, scratch_path(spark, "t-odd")).collect()) == want


def test_only_texts_that_rows_share_travel(spark):
    """Contents of one row are encoded where they are read; of others one text; none with a stored count."""
    from hourmill.llm.token_counts import unseen_texts

    rows = [(i, f"own {i}", f"o{i}") for i in range(500)] + [(900 + i, f"copy {i % 10}", f"c{i % 10}") for i in range(40)]
    rows += [(None, "no id", "x"), (None, "no id", "x"), (7000, "stored", "s"), (7001, "stored", "s"), (7002, "stored too", "t")]
    texts = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(3)
    found = spark.createDataFrame(
        [(d, min((i for i, _, e in rows if e == d and i is not None), default=None), sum(r[2] == d for r in rows), d in "st" or None) for d in {r[2] for r in rows}],
        "digest string, first_id long, n long, known boolean",
    )
    alone, rest = unseen_texts(texts, found)
    alone, rest = Counter(tuple(r) for r in alone.collect()), Counter(tuple(r) for r in rest.collect())
    assert alone + rest == Counter({(d, t) for _, t, d in rows if d not in "st"})  # each content once
    assert len(rest) < 20 and {(f"c{i}", f"copy {i}") for i in range(10)} | {("x", "no id")} <= set(rest)


def test_cap_filters(spark):
    from hourmill.llm.cap_filters import near_vectors

    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 64))
    near = base[:30] + 0.15 * rng.normal(size=(30, 64))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)] + [(100 + i, v.tolist(), i % 3) for i, v in enumerate(near)]
    rows += [(200 + i, base[0].tolist(), 0) for i in range(20)] + [(300, (base[0] * 2).tolist(), 0), (301, base[0].tolist(), 1)]
    rows += [(400, None, 0), (401, [0.0] * 64, 0), (402, [float("nan")] * 64, 0), (403, [None] * 64, 0), (404, base[1].tolist(), None)]
    rows += [(405, [float("inf")] * 64, 0), (406, [], 0), (407, [1.0, 2.0], 0), (408, [2.0, 4.0], 0), (0, base[0].tolist(), 0), (None, base[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as class", "2 as n", "3 as comp")
    usable = {i: (np.array(v), k) for i, v, k in rows if i is not None and k is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = defaultdict(set)
    for i, (a, k) in usable.items():
        for j, (b, m) in usable.items():
            if i != j and k == m and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                links[i].add(j)

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    got = near_vectors(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), least(r.vec_id), least(r.vec_id) == r.vec_id)
    assert near_vectors(df.limit(0)).count() == 0


def test_cap_filters_leave_little_on_disk(spark):
    """Filters and pairs go once they were used; vectors of floats are written as such, with the results of doubles."""
    from hourmill.llm.cap_filters import near_vectors
    from hourmill.session import child_names, shared_root

    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 64)).astype(np.float32)
    vectors = np.concatenate([base, base + np.float32(0.04) * rng.normal(size=base.shape).astype(np.float32), base[:5]])
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    folder = f"{shared_root(spark)}/hourmill"
    got = []
    for kind in ("float", "double"):
        df, before = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int"), set(child_names(spark, folder))
        got.append(sorted(map(tuple, near_vectors(df).collect())))
        left = set(child_names(spark, folder)) - before
        assert not [x for x in left if x.startswith(("caps-", "vector-pairs-"))]
        (classes,) = [x for x in left if x.startswith("vector-classes-")]
        assert dict(spark.read.parquet(f"{folder}/{classes}").dtypes)["v"] == f"array<{kind}>"
    assert got[0] == got[1] and sum(r[1] for r in got[0]) >= 80


def test_pipeline_by_brute_force(spark):
    """Every stage's decisions take effect on all its predecessor kept."""
    import corpus_pipeline as p
    from hourmill.llm.near_dup import near_duplicates
    from hourmill.llm.quality_classifier import score_documents
    from hourmill.llm.quality_rules import apply_rules

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in score_documents(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("predicted = 1").collect()}
    left = docs.filter(docs.doc_id.isin(list(good)))
    left = left.filter(left.doc_id.isin([r.doc_id for r in apply_rules(left).filter("kept").collect()]))
    root = brute_components({i: shingles(t) for i, t in texts(left)})
    want = {i for i, r in root.items() if i == r}
    pieces = p.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == want and 0 < len(want) < docs.count()
    stage = docs
    for _, f in p.STAGES[:-1]:
        stage = f(spark, stage, sf)
        assert stage.columns == docs.columns
    assert {r.doc_id for r in near_duplicates(left).filter("kept").collect()} == want


@pytest.mark.parametrize("stage", ["quality_classifier", "quality_rules", "near_dedup", "surrogates", "packing"])
def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, stage):
    import corpus_pipeline as p

    f = dict(p.STAGES)[stage]
    out = f(spark, odd_docs, "/root/testdata/sf0.001")
    assert out.count() > 0 and f(spark, no_docs, "/root/testdata/sf0.001").count() == 0
    if stage != "packing":
        assert out.columns == odd_docs.columns
