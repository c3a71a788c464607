"""Lexical search, conversation repair and the language model against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests import oracle
from tillroll.llm import lexical, ngram, repair
from tillroll.llm.queries import ORACLES, QUERIES

SF = f"{oracle.DATA}/sf0.001"

# ---- lexical search -------------------------------------------------------------------


def brute_search(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(terms(t))
    out = {}
    for item, held in asked.items():
        found = []
        for i, c in counted:
            m = 100 - 75 + (75 * c.total() * n_docs) // length if length else 0
            s = 0
            for t, times in held.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s:
                found.append((-s, i is None, i or 0))
        out[item] = [(None if none else i, -s) for s, none, i in sorted(found)[:k]]
    return {i: v for i, v in out.items() if v}


def ranked(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.item_id is not None, r.item_id or 0, r["rank"])):
        out[r.item_id].append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return dict(out)


def pairs(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_search_matches_sql(llm):
    con = oracle.connect(SF)
    assert oracle.compare(QUERIES["op12_lexical"](llm, SF), con, ORACLES["op12_lexical"]) == []


def test_search_of_odd_rows(llm, odd, none, monkeypatch):
    asked = [(1, "RIVER amber 12345"), (1, "river"), (2, None), (3, " .. "), (None, "é ß violet7"), (4, "absent"), (5, "x x x"), (5, "x x x")]
    items = llm.createDataFrame([(*a, 0, 0) for a in asked], "item_id long, text string, doc_id int, score int")
    want = brute_search(pairs(odd, "doc_id", "text"), asked)
    assert ranked(lexical.search(odd, items).collect()) == want and set(want) == {1, None, 5}
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", 1)  # an item per block
    monkeypatch.setattr(lexical, "CELLS", 4)
    monkeypatch.setattr(lexical, "CUT", 16)
    assert ranked(lexical.search(odd, items).collect()) == want
    assert lexical.search(none, items).count() == lexical.search(odd, items.where("false")).count() == 0
    assert lexical.search(odd.where("text is null"), items).count() == 0


def test_search_ties_and_hot_terms(llm):
    docs = [(i, "common " * (1 + i % 3) + ("rare" if i % 500 == 0 else "")) for i in range(3000)]
    items = [(0, "common rare"), (1, "common"), (2, "rare rare")]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = ranked(lexical.search(df, llm.createDataFrame(items, "item_id long, text string"), k=25).collect())
    assert got == brute_search(docs, items, 25)


def test_scores_are_exact_beyond_doubles():
    index = lexical.ItemIndex([(0, {b"a": 3, b"b": 1}), (1, {b"a": 1})])
    gain = np.array([(1 << 58) + 1, (1 << 57) + 3], np.int64)
    got = lexical._scores(index, np.array([0, 1]), gain, np.array([0, 0]), 1)
    assert got.tolist() == [[3 * ((1 << 58) + 1) + (1 << 57) + 3, (1 << 58) + 1]]


# ---- conversation repair -----------------------------------------------------------------

FOLLOWS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAME = {"u": "user", "a": "assistant"}


def damaged(rows):
    conversations = defaultdict(list)
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text = " " if role is None else role, " " if text is None else text
        own, fault = conversations[c], zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        own += [(t, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return conversations


def cheapest(rows, faults):
    """(cost, audit, rows that remain), by a search forward that carries the edits themselves."""

    def better(best, state, cost, edits, kept):
        if state not in best or (cost, edits) < best[state][:2]:
            best[state] = (cost, edits, kept)

    def with_inserts(best):
        for _ in range(3):
            for q, (cost, edits, kept) in list(best.items()):
                for x in FOLLOWS[q].keys() & NAME.keys():
                    better(best, FOLLOWS[q][x], cost + 5, edits + "I", (*kept, (NAME[x], "")))
        return best

    best = with_inserts({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        now = {}
        more = 5 if fault == "truncated" else 0
        for q, (cost, edits, kept) in best.items():
            better(now, q, cost + 2, edits + "D", kept)
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] in FOLLOWS[q]:
                better(now, FOLLOWS[q][role[:1]], cost + more, edits + "K", (*kept, (role, text)))
            for x in FOLLOWS[q].keys() & NAME.keys():
                better(now, FOLLOWS[q][x], cost + more + 1, edits + "R", (*kept, (NAME[x], text)))
        best = with_inserts(now)
    return min((best[q] for q in (0, 3) if q in best), key=lambda b: b[:2])


def brute_audit(rows):
    out = {}
    for c, own in damaged(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        first = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit, kept = cheapest(own, faults)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in kept))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def audited(df, **settings):
    rows = repair.audit(df, **settings).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"


def rough(n, seed):
    """Conversations of very different lengths with all that may be wrong in them."""
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    return [
        (
            c,
            pick(None, i, i, i, i // 2, 7),
            pick("user", "assistant", "user", "assistant", "system", None, "tool", ""),
            pick(None, "", "a.", "b", "c! ", f"{i}.", f"{i}?", f"{i}", "d \n"),
        )
        for c, size in ((1, n), (2, n // 10), (None, n // 10), (4, 1), (1 << 60, 2))
        for i in range(size)
    ]


@pytest.mark.parametrize("chunk_rows", [8192, 40, 3])
def test_repair_of_rough_conversations(llm, chunk_rows):
    rows = rough(300, 3)
    assert audited(llm.createDataFrame(rows, SCHEMA), chunk_rows=chunk_rows) == brute_audit(rows)


def test_repair_of_the_table(llm):
    df = llm.read.parquet(f"{SF}/conversations.parquet")
    want = brute_audit(pairs(df, "conv_id", "turn", "role", "text"))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_repair"](llm, SF).collect()}
    assert got == want and any("D" in w[6] for w in want.values())


def test_few_passes_though_nothing_converges(llm):
    # turns that are all rewritten: both phases cost the same, so no chunk forgets its end
    rows = [(1, i, "tool", f"{i}.") for i in range(600)] + [(2, i, "user", "same.") for i in range(50)]
    df = llm.createDataFrame(rows, SCHEMA)
    found = repair.repair(repair.damage(df), chunk_rows=10)
    assert found.passes <= 4
    assert audited(df, chunk_rows=10) == brute_audit(rows)


def test_fix_up_equals_a_new_run():
    rng = random.Random(5)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 7, 8, 12]) for _ in range(rng.randrange(1, 40)))
        start, total = repair.sweep(codes, repair.END)
        end = repair.sweep(bytes(rng.choices([1, 2, 3, 6], k=3)), repair.END)[0]
        assert repair.fix_up(codes, repair.END, end, start, total) == repair.sweep(codes, end)


def test_repair_of_lost_and_empty_conversations(llm):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = llm.createDataFrame([(lost, 0, "user", "Hi.", "x")], f"{SCHEMA}, audit string")
    assert audited(df) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert audited(df.where("false")) == {}


def test_long_texts_of_a_conversation_over_chunks(llm, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 100)
    rows = [(3, i, "user" if i % 2 else "assistant", "word " * (i * 20) + f"{i}.") for i in range(60)]
    assert audited(llm.createDataFrame(rows, SCHEMA), chunk_rows=9) == brute_audit(rows)


# ---- language model ------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


class BruteModel:
    """Kneser-Ney by its definition, over dictionaries of tuples."""

    def __init__(self, texts, order):
        self.order, self.seen, raw = order, Counter(), defaultdict(Counter)
        for t in texts:
            self.seen.update(words(t))
            t = ["<s>", *words(t)]
            for n in range(2, order + 1):
                raw[n].update(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
        self.grams = {order: raw[order]}
        for n in range(order - 1, 0, -1):
            self.grams[n] = Counter(k[1:] for k in raw[n + 1])
            self.grams[n].update({k: c for k, c in raw[n].items() if k[0] == "<s>"} if n > 1 else {})
        self.off = {n: [0, *ngram.discounts([list(g.values()).count(i) for i in (1, 2, 3, 4)])] for n, g in self.grams.items()}
        self.context = defaultdict(lambda: [0, 0.0])
        for n, g in self.grams.items():
            for k, c in g.items():
                self.context[n, k[:-1]][0] += c
                self.context[n, k[:-1]][1] += self.off[n][min(c, 3)]

    def p(self, context, word, n):
        if not n:
            return 1 / (len(self.seen) + 1)
        shorter = self.p(context[1:], word, n - 1)
        if (n, context) not in self.context:
            return shorter
        total, left = self.context[n, context]
        c = self.grams[n][(*context, word)]
        return (max(c - self.off[n][min(c, 3)], 0) + left * shorter) / total

    def row(self, text):
        t = ["<s>", *words(text)]
        score = base = 0.0
        n_all = self.seen.total()
        for i, w in enumerate(t[1:], 1):
            before = tuple(t[max(0, i - self.order + 1) : i])
            score += math.log10(self.p(before, w, len(before) + 1))
            base += math.log10((self.seen[w] + 0.5) / (n_all + 0.5 * (len(self.seen) + 1)))
        return len(t) - 1, sum(w in self.seen for w in t[1:]), n_all, base, score


def same_scores(df, order):
    rows = pairs(df, "doc_id", "text")
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    model = BruteModel([t for i, t in rows if not held(i)], order)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    want = sorted(((i, held(i), *model.row(t)) for i, t in rows), key=key)
    got = sorted((tuple(r)[:7] for r in ngram.perplexities(df, order).collect()), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for i in (5, 6):
        assert [g[i] for g in got] == pytest.approx([w[i] for w in want], rel=1e-9, abs=1e-9)
    return got


def test_discounts():
    assert ngram.discounts([4, 3, 2, 1]) == pytest.approx((1 - 2 * 0.4 * 0.75, 2 - 3 * 0.4 * 2 / 3, 3 - 4 * 0.4 * 0.5))
    assert ngram.discounts([9, 0, 1, 1]) == (0.5, 1.0, 1.5)


def test_spark_and_worker_agree_on_words():
    (t,) = ngram.tokens(["One two\ttwo", None], 1)
    hashed = [xxhash.xxh64_intdigest(w, 42) for w in (b"one", b"two", b"two", b"\n", b"\n")]
    assert t.word.view(np.uint64).tolist() == hashed
    assert t.doc.tolist() == [0, 0, 0, 0, 1] and t.place.tolist() == [0, 1, 2, 3, 0] and t.fresh.all()


@pytest.mark.parametrize("order", [2, 3])
def test_model_on_the_table(llm, order):
    got = same_scores(llm.read.parquet(f"{SF}/documents.parquet"), order)
    unseen = [r for r in got if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_model_of_few_words(llm, order, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices("a b c d e F g aa bb the of".split(), k=rng.choice([0, 1, 2, 5, 40]))) for _ in range(120)]
    df = llm.createDataFrame([*enumerate(texts), (None, "a b"), (5, None), (5, "a  b")], "doc_id long, text string")
    same_scores(df, order)


@pytest.mark.parametrize("share", [1 << 21, 200])
def test_model_in_several_ranges(llm, odd, share, monkeypatch):
    monkeypatch.setattr(ngram, "PART_KEYS", 50)
    monkeypatch.setattr(ngram, "SAMPLE_KEYS", share)
    rng = random.Random(2)
    texts = [" ".join(rng.choices("a b c d e F g aa bb the of".split(), k=40)) for _ in range(60)]
    same_scores(llm.createDataFrame([*enumerate(texts)], "doc_id long, text string"), 2)
    same_scores(odd, 3)


def test_counts_are_computed_once(llm, monkeypatch):
    monkeypatch.setattr(ngram, "PART_KEYS", 50)
    texts = [(" ".join(f"w{i * j % 37}" for j in range(100)),) for i in range(40)]
    read = llm.sparkContext.accumulator(0)

    def keys(texts):
        for t in ngram.tokens(texts, 0):
            read.add(len(t.word))
            yield t.word

    docs = llm.createDataFrame(texts, "text string")
    borders = np.array([-(1 << 62), 0, 1 << 62])
    table = ngram.save(ngram._counted(docs, keys, borders), "once", borders=borders)
    assert table.total == read.value == 40 * 101 and len(table.shards) > 1


def test_model_of_odd_rows(llm, odd, none):
    same_scores(odd, 2)
    same_scores(odd, 3)
    assert ngram.perplexities(none).count() == 0
    assert [r[2:7] for r in same_scores(odd.where("doc_id is null"), 2)][0][1:3] == (0, 0)  # nothing to learn from


def test_texts_in_pieces(monkeypatch):
    texts = [" ".join(f"w{i % 13}" for i in range(500)), "  " * 400 + "x y", "long" * 300 + " z z"]
    whole = list(ngram.tokens(texts, 2))
    pieces = ngram.word_blocks
    monkeypatch.setattr(ngram, "word_blocks", lambda t, carry: pieces(t, carry, size=50))
    monkeypatch.setattr(ngram, "BLOCK", 64)
    cut = list(ngram.tokens(texts, 2))
    assert len(cut) > 5
    for name in ("word", "doc", "place"):
        assert np.concatenate([getattr(t, name)[t.fresh] for t in cut]).tolist() == getattr(whole[0], name).tolist()


def test_probabilities_add_up_to_one(llm):
    texts = ["a b a c b a", "c c b", "b a a d", "", "a b d"]
    model = ngram.train(llm.createDataFrame([(t,) for t in texts], "text string"), 3)
    for start in ("", "a ", "a b ", "c c ", "zz "):
        block = next(ngram.tokens([start], 2))
        at = len(block.word) - 1
        total = 0.0
        for w in (b"a", b"b", b"c", b"d", b"\n", b"unseen"):
            block.word[at] = np.array([xxhash.xxh64_intdigest(w, 42)], np.uint64).view(np.int64)[0]
            total += 10 ** model.log10(block)[0][at]
        assert total == pytest.approx(1.0)
