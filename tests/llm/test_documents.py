"""Operators over documents against brute force, on odd rows and on the given tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tests import oracle
from tests.llm.conftest import WORDS
from tillroll.llm import components, decontam, langid, mixing, sharding, simhash, tokencount, tokenfile, toxicity
from tillroll.llm.queries import PIECES, QUERIES, WORD_BPE as BPE
from tillroll.llm.text import CodeTable, folded, gram_codes, word_blocks

SF = f"{oracle.DATA}/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


# ---- shared pieces ------------------------------------------------------------------


def test_code_table_finds_exactly_the_known():
    rng = np.random.default_rng(1)
    known = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    asked = np.concatenate([known[::3], rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    table = CodeTable(known)
    at, found = table.find(asked)
    assert sorted(at.tolist()) == [i for i, c in enumerate(asked) if c in set(known.tolist())]
    assert (table.codes[found] == asked[at]).all()
    assert len(CodeTable(known[:0]).find(asked)[0]) == 0


def test_folded_and_codes():
    assert "".join(map(chr, folded("  A-b\n\nÉ9_c  "))) == "a b é9 c"
    assert not len(folded(" .. ")) and not len(folded(None))
    assert len(gram_codes(folded("abc"), 4)) == 0


def test_long_texts_are_read_in_blocks():
    text = " ".join(WORDS[i % 7] for i in range(5000))
    blocks = list(word_blocks(text, 2, size=1000))
    joined = blocks[0] + [w for b in blocks[1:] for w in b[2:]]
    assert len(blocks) > 3 and joined == text.encode().split()


# ---- near-copies --------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [re.sub(rb"[A-Z]", lambda m: m.group().lower(), w) for w in words]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(llm):
    texts = [None, "", " \n", "One", "One TWO", "Ä b C d", "a b c a b c"]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprint("") == 0


def test_fingerprints_of_long_first_words():
    long = "w" * (1 << 20)
    texts = [f"{long} b c d", f"{long} {long}", "a b" + " " * (1 << 20) + "c d e", f"{long} {long} {long}", f"a{' ' * (1 << 20)}b"]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_unique_text_of_a_repeated_id_stays(llm):
    rows = [(1, "river stone cloud amber field"), (2, "river stone cloud amber field"), (2, "lantern harbor violet candle copper")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == [rows[0], rows[2]]


def brute_components(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_links_lose_nothing(llm):
    """A chain, a dense cluster, edges at both ends of the word, and strangers."""
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1, 1 << 63, 3 << 62, 1, (1 << 64) - 2}
    for _ in range(30):
        prints.add(rng.getrandbits(64))
    at = rng.getrandbits(64)
    for i in range(40):
        at ^= 1 << rng.randrange(64)
        at ^= 1 << rng.randrange(64)
        prints.add(at)
    hub = rng.getrandbits(64)
    prints |= {hub ^ (1 << i) ^ (1 << j) for i in range(6) for j in range(i)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    roots = components.components(simhash.links(llm.createDataFrame(signed, "fp long"))).collect()
    want = brute_components(sorted(prints))
    groups: dict = {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(p)
    got: dict = {}
    for r in roots:
        got.setdefault(r.root, set()).add(r.node % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_long_chain_and_star(llm):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3)]
    found = components.components(llm.createDataFrame(chain, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_query(llm):
    rows = QUERIES["op4_simhash"](llm, SF).collect()
    docs = documents(llm)
    prints = {d: brute_fingerprint(t) for d, t in zip(docs.doc_id, docs.text)}
    root = brute_components(sorted(set(prints.values())))
    smallest: dict = {}
    for d, p in prints.items():
        smallest[root[p]] = min(d, smallest.get(root[p], d))
    assert len(rows) == len(docs)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == smallest[root[prints[r.doc_id]]]


def test_near_copies_of_odd_rows(odd, none):
    rows = simhash.near_copies(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    assert none.count() == 0 and simhash.near_copies(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    left = kept.collect()
    assert {(r["_fp"], r["_id"]) for r in left} == {("own", "own")}
    ids = [r.doc_id for r in left]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 7] and ids.count(None) == 2


# ---- decontamination ----------------------------------------------------------------


def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_search_equals_edit_distance():
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4, 14)))) for i in range(12)]
    index = decontam.Index.build(items)
    hits = 0
    for _ in range(60):
        i, item = rng.choice(items)
        noisy = list(item)
        for _ in range(rng.randrange(0, len(item) // 6)):
            k = rng.randrange(len(noisy))
            noisy[k : k + 1] = rng.choice([[], ["z"], [noisy[k], "q"]])
        text = " ".join(rng.choice(WORDS) for _ in range(6)) + " " + "".join(noisy) + " " + "end"
        plain = "".join(map(chr, folded(text)))
        got = {j: e for j, e, _ in decontam.search(text, index)}
        for k, (j, other) in enumerate(items):
            edits = brute_edits("".join(map(chr, folded(other))), plain)
            if edits <= index.budget[k]:
                assert got[j] == edits
                hits += 1
            else:
                assert j not in got
    assert hits > 30


def test_short_items_have_the_same_budget():
    """Items of 8 to 45 characters against edit distance, at a tenth of their length."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    hits = [0, 0]
    for n in range(8, 46):
        item = "".join(rng.choice(letters) for _ in range(n))
        index = decontam.Index.build([(1, item), (2, item[::-1])])
        assert index.budget.tolist() == [n // 10] * 2 and (index.need >= 1).all()
        for _ in range(30):
            noisy = list(item)
            for _ in range(rng.randrange(n // 10 + 2)):
                k = rng.randrange(len(noisy))
                noisy[k : k + 1] = rng.choice([[], ["é"], [noisy[k], "ñ"]])
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(40))) + "".join(noisy) + "xyz"
            got = {j: e for j, e, _ in decontam.search(text, index)}
            for j, own in ((1, item), (2, item[::-1])):
                edits = brute_edits(own, text)
                assert got.get(j) == (edits if edits <= n // 10 else None), (own, text)
            hits[1 in got] += 1
    assert min(hits) > 100


def test_items_under_a_gram_are_whole_words(monkeypatch):
    items = [(1, "2+2"), (2, "日本の首都"), (3, "Paris?"), (4, "x"), (5, " .. "), (6, "paris"), (7, "日本")]
    index = decontam.Index.build(items)
    found = lambda text: [(j, e) for j, e, _ in decontam.search(text, index)]
    assert found("What is 2+2?") == [(1, 0)]
    assert found("12 22 comparison") == []
    assert found("次の問い:日本の首都はどこですか") == [(2, 0), (7, 0)]
    assert found("in Paris, X") == [(3, 0), (4, 0), (6, 0)]
    assert found("") == found(None) == found("...") == []
    monkeypatch.setattr(decontam, "_CHUNK", 64)
    for pad in range(50, 140):  # the word lies on either side of and across a border of blocks
        assert found("b" * pad + " paris " + "c" * 80) == [(3, 0), (6, 0)], pad
        assert found("b" * pad + "paris " + "c" * 80) == [], pad
        assert found("b" * pad + " parisian " + "c" * 80) == [], pad


def test_items_that_begin_alike():
    """Many items of one opening, and a text that repeats the opening: only whole items match."""
    opening = "which of the following statements about the river is "
    items = [(i, f"{opening}{i:04d} {WORDS[i % 12]}{i * 7919 % 10007:05d} {'abcdefgh'[i % 8] * 9}") for i in range(60)]
    index = decontam.Index.build(items)
    assert decontam.search(opening * 40, index) == []
    got = {j for j, _, _ in decontam.search(opening * 5 + items[17][1] + " so", index)}
    plain = "".join(map(chr, folded(opening + items[17][1])))
    want = {j for j, t in items if brute_edits("".join(map(chr, folded(t))), plain) <= len(folded(t)) // 10}
    assert 17 in got and got == want


def test_search_over_chunk_borders(monkeypatch):
    monkeypatch.setattr(decontam, "_CHUNK", 400)
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    index = decontam.Index.build([(1, item)])
    for pad in range(300, 460, 7):
        assert decontam.search("ab " * (pad // 3) + "A" * (pad % 3) + " " + item.upper() + " cd" * 300, index)


def test_contamination_query(llm):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontaminate"](llm, SF).collect() if r.edits == 0}
    docs, items = documents(llm), llm.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, b in zip(items.item_id, items.text) if b in t}
    assert want and want <= got


def test_contamination_of_odd_rows(llm, odd, none):
    items = llm.createDataFrame(
        [(1, "river stone cloud amber"), (2, None), (None, "river stone"), (3, "x"), (1, "river stone cloud amber")],
        "item_id long, text string",
    )
    found = decontam.contamination(odd, items).collect()
    # the one-letter item stands whole in the one-letter document
    assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in found) == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (6, 3, 0)]
    assert decontam.contamination(none, items).count() == 0
    assert decontam.contamination(odd, items.where("false")).count() == 0
    left = decontam.clean(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 4


def test_benchmark_in_blocks(llm):
    items = [(i, f"{WORDS[i % 12]} {i} " * 5) for i in range(50)]
    df = llm.createDataFrame(items, "item_id long, text string")
    parts = list(decontam.blocks(df, block_chars=200))
    assert len(parts) > 3 and sorted(x for p in parts for x in p) == sorted(items)


# ---- language and toxicity ----------------------------------------------------------


def test_language_held_out(llm):
    rows = QUERIES["op2_language_id"](llm, f"{oracle.DATA}/sf0.01").toPandas()
    docs = llm.read.parquet(f"{oracle.DATA}/sf0.01/documents.parquet").toPandas()
    both = rows.merge(docs, on="doc_id")
    assert len(rows) == len(docs)
    assert (both.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in both.doc_id]).all()
    assert rows.score.between(0, 1).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_language_of_odd_rows(odd, none):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (2, 3, 4) or (r.doc_id is None and r.score == 0)) for r in rows)
    assert langid.identify(none).count() == 0


def test_no_letter_no_language(llm):
    texts = ["\U0001f600", "\U0001f600\U0001f600 12", "\U0001d7d9\U0001d7da", "123", "der Hund \U0001f600"]
    rows = [(i, f"le chien {i} court vite et loin", "fr") for i in range(100, 140)] + [(i, t, None) for i, t in enumerate(texts)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert [got[i] for i in range(5)] == ["und"] * 4 + ["fr"]
    assert "".join(map(chr, folded("a\U0001f600\U00010400b \U0001d7d9", digits=False))) == "a \U00010428b"


def test_far_text_is_rejected():
    model = langid.Model(["xx"], np.ones(1 << langid.BUCKET_BITS), np.zeros((1 << langid.BUCKET_BITS, 1)), np.array([0]), np.array([0.5]))
    assert model.predict("anything") == ("xx", 0.0, True)


def toxic_table(llm):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(WORDS) + rng.choice("aeiou") for _ in range(30)]
        bad = i % 4 == 0
        if bad or i % 9 == 0:
            words[rng.randrange(1, 29)] = "muslim"
        if bad:
            words[0] = "grumok" + rng.choice(["", "a", "en", "ish"])
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return llm.createDataFrame(rows, "doc_id long, text string"), llm.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_stems_and_ignores_groups(llm):
    docs, labels = toxic_table(llm)
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = rows[rows.held_out]
    assert (held.predicted == held.toxic).all()
    free = toxicity.fit(docs, labels, penalty=0.0)
    tied = toxicity.fit(docs, labels, penalty=50.0)
    change = lambda m: abs(m.score("they are muslim people") - m.score("they are hindu people"))
    assert change(tied) < change(free)


def test_counterfactuals():
    ((a, b),) = toxicity.swapped("Nothing here. The Muslim neighbour sings! Bye.")
    assert "Muslim" in a and "neighbour" in b and "Muslim" not in b
    assert toxicity.swapped(None) == []
    many = toxicity.swapped(" ".join(f"Group {i % 20} has women." for i in range(60)))
    assert len(many) == 20 and not any("women" in b for _, b in many)


def test_toxicity_of_odd_rows(llm, odd, none):
    docs, labels = toxic_table(llm)
    odd_labels = labels.unionByName(llm.createDataFrame([(None, 1), (5, None), (5, 1)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, odd_labels)
    scores = odd.select(toxicity.score_column("text", model).alias("s")).collect()
    assert len(scores) == odd.count() and all(0 <= r.s <= 1 for r in scores)
    assert toxicity.classify(odd, labels.where("false")).where("predicted = 1").count() == 0
    assert toxicity.classify(none, labels).count() == 0
    assert toxicity.clean(odd, labels.where("false")).columns == odd.columns


# ---- tokens -------------------------------------------------------------------------


def test_token_files_round_trip(llm):
    rows = sorted(QUERIES["op5_token_files"](llm, SF).collect(), key=lambda r: r.doc_id)
    tokenizer, start = Tokenizer.from_file(BPE), 0
    docs = documents(llm).sort_values("doc_id")
    for r, d, t in zip(rows, docs.doc_id, docs.text, strict=True):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), crc)
        start += len(ids)


@pytest.mark.parametrize("renewed", [False, True])
def test_word_encoder_is_the_tokenizer(renewed, monkeypatch):
    if renewed:
        monkeypatch.setattr(tokenfile, "CACHED_WORDS", 3)
    texts = [
        "It's 12 o'clock, DON'T stop!!", "İstanbul ΣΊΣΥΦΟΣ été ﬁne Ǆ", "a\x0bb\x0cc\x1cd\xa0e　f", "",
        "<|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>", "%%% word%%% ***", "漢字 😀 word😀", "naïve façade ÜBER straße", None,
    ]
    e, t = tokenfile.WordEncoder(BPE), Tokenizer.from_file(BPE)
    for _ in range(2):
        for text in texts:
            (raw,) = e.encode([text])
            assert np.frombuffer(raw, "<u2").tolist() == t.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files_of_odd_rows(llm, odd, none, tmp_path):
    dictionary = tokenfile.train_dictionary(odd, BPE)
    files = tokenfile.write(odd, str(tmp_path / "tokens"), BPE, dictionary)
    back = tokenfile.read_back(files, dictionary).orderBy("start").collect()
    assert len(back) == odd.count() and back[0].start == 0 and back[0].doc_id is None
    assert all(a.start + a.n_tokens == b.start for a, b in zip(back, back[1:]))
    first = tokenfile.TokenFile(files.first().uri, dictionary)
    places = first.find(1)
    assert len(places) == 2 and first.ids(places[0]).tolist() == first.ids(places[1]).tolist()
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfile.TokenFile(files.first().uri, b"other")
    assert tokenfile.tokenize(none, BPE).count() == 0


def test_token_counts(llm, odd, none):
    model = tokencount.load(PIECES)
    rows = QUERIES["op6_token_counts"](llm, SF).collect()
    text = dict(zip(documents(llm).doc_id, documents(llm).text))
    for r in rows:
        words = text[r.doc_id].encode().split()  # the vocabulary tells capitals apart
        assert (r.n_words, r.n_tokens) == (len(words), sum(model.count_one(w.decode()) for w in words))
    assert len(rows) == len(text)
    assert [r.n_tokens for r in tokencount.token_counts(odd, PIECES).where("doc_id in (2, 3, 4)").collect()] == [0] * 3
    assert tokencount.token_counts(none, PIECES).count() == 0


def test_trie_equals_plain_programming():
    rng = random.Random(2)
    model = tokencount.Unigram(["▁", "a", "b", "ab", "▁a", "ba", "abab", "▁ab"])
    words = sorted({"".join(rng.choice("abc😀") for _ in range(rng.randrange(0, 30))) for _ in range(300)} | {"a" * 500})
    assert model.count(words).tolist() == [model.count_one(w) for w in words]
    assert model.count([]).tolist() == []


# ---- shards and mixtures ------------------------------------------------------------


def test_shards(llm):
    rows = QUERIES["op8_sharding"](llm, SF).toPandas()
    docs = documents(llm).set_index("doc_id")
    assert len(rows) == len(docs) and set(rows.law) == {"key"}
    assert rows.shard.between(0, 15).all()
    moved = rows[rows.shard != rows.grown_shard]
    assert set(moved.grown_shard) == {16}
    for _, g in rows.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    for r in rows.itertuples():
        raw = docs.text[r.doc_id].encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)


def test_shards_of_odd_rows(odd, none, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", 1)  # many slices
    rows = sharding.assign(odd, 2).toPandas()
    assert len(rows) == odd.count()
    for _, g in rows.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert rows[rows.doc_id == 2][["size", "text_crc32"]].values.tolist() == [[1, 0]]
    assert sharding.assign(none).count() == 0


def test_tree_follows_weights(llm):
    root = sharding.tree(4, regions=2, racks=1, weights=[1, 1, 2, 0])
    n = llm.range(20_000).select(sharding.shard_of(sharding.F.col("id").cast("string"), root).alias("s")).groupBy("s").count()
    share = {r.s: r["count"] / 20_000 for r in n.collect()}
    assert share.keys() == {0, 1, 2} and abs(share[2] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02


def brute_targets(sizes, weights=(3, 1, 2)):
    """Targets of sources in order, by resharing the excess until none is above."""
    total, capped = 1.5 * sum(sizes), set()
    w = [weights[i % 3] for i in range(len(sizes))]
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(2 * sizes[i] for i in capped)
        level = left / sum(w[i] for i in free) if free else 0
        over = {i for i in free if w[i] * level > 2 * sizes[i]}
        if not over:
            return [2.0 * sizes[i] if i in capped else w[i] * level for i in range(len(sizes))]
        capped |= over


def check_mix(rows):
    g = rows.groupby("source", dropna=False).agg(
        target=("target", "first"), taken=("taken", "sum"), own=("source_size", "first"), size=("size", "sum")
    )
    g = g.sort_index(na_position="last")
    assert (g.own == g["size"]).all()
    assert np.allclose(g.target, brute_targets(g.own.tolist()))
    assert ((rows.taken >= 0) & (rows.taken <= 2 * rows["size"])).all()
    return g


def test_mixing(llm):
    rows = QUERIES["op9_mixing"](llm, SF).toPandas()
    text = documents(llm).set_index("doc_id").text
    assert len(rows) == len(text)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id])) for r in rows.sample(50, random_state=1)[["doc_id", "size"]].rename(columns={"size": "n"}).assign(size=lambda x: x.n).itertuples())
    g = check_mix(rows)
    assert (abs(g.target - g.taken) <= 1).all()
    tilted = rows[(rows["size"] > 0) & (rows.rate < 2)]
    for _, s in tilted.groupby("source"):  # the tilt of a source is one exponent
        x, y = s["size"].to_numpy(float), np.log(s.rate.to_numpy())
        assert np.allclose(y * x[0], y[0] * x, atol=1e-6 * max(x))
    again = QUERIES["op9_mixing"](llm, SF).toPandas()
    assert rows.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_mixing_of_odd_rows(odd, none):
    rows = mixing.mix(odd).toPandas()
    assert len(rows) == odd.count()
    check_mix(rows)
    assert mixing.mix(none).count() == 0
    copied = mixing.copies(odd)
    assert copied.columns == odd.columns and copied.where("doc_id = 5").count() >= 1
    assert mixing.copies(none).count() == 0


# ---- near-copies by shingles ----------------------------------------------------------


def test_stage_keeps_the_first_of_each_class(llm):
    docs = documents(llm)
    prints = {d: brute_fingerprint(t) for d, t in zip(docs.doc_id, docs.text)}
    root = brute_components(sorted(set(prints.values())))
    first: dict = {}
    for d, p in prints.items():
        first[root[p]] = min(d, first.get(root[p], d))
    kept = corpus_pipeline.drop_near_copies(llm, llm.read.parquet(f"{SF}/documents.parquet"), SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(first.values())


def test_stage_of_odd_rows(llm, odd, none):
    kept = corpus_pipeline.drop_near_copies(llm, odd, SF)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 7] and ids.count(None) == 2
    assert corpus_pipeline.drop_near_copies(llm, none, SF).count() == 0
