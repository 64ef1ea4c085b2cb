"""Every operator on odd rows and against a plain version of what it computes."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from pmweave.llm import bpe, chat, classifier, components, fingerprints, meetings, mixing, quality, simhash, splicing, tokens, urls, vectors, warc
from pmweave.llm.fingerprints import simhash as fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, id string"
RANKS, JSON = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977} tail{i}" for i in range(30_000))
TEXTS = [None, "", " \n\t", "one", "One two three four five six", "one  two THREE four five six", LONG, LONG + " end", "a\nb\na\n\nb", "é ß <|endoftext|> 中文"]


def odd_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows and ids, columns named like the operators' own."""
    rows = [(i, t, None, f"s{i % 3}", None, 7, "x") for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[6], (None, TEXTS[4], "en", None, 1, None, None), (None, None, None, None, None, None, None), (4, "another text", None, "s1", 2, 3, "y")]
    return spark.createDataFrame(rows, DOCS)


def plain_components(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components_equal_a_plain_search(spark):
    draw = random.Random(3)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(400, i) for i in range(401, 460)]
    frame = spark.createDataFrame(links + [(None, 1), (5, None), (7, 7)], "a long, b long")
    want = plain_components(460, links)
    got = {r.node: r.root for r in components.connected(frame, "a", "b").collect()}
    assert got == {i: want[i] for i in range(460) if want[i] != i}


def test_warc_round_trip_of_odd_pages(spark):
    big = "x" * 200_000
    rows = [(1, "http://a/\r\nb", big, 1), (2, None, big, 1), (2, None, big, 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "short", 1), (6, "u", "short", 1), (None, "u", big, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_id long")
    got = warc.read_archives(warc.archive_pages(pages.repartition(2)), keep_payload=True).collect()
    assert len(got) == len(rows) and not [r for r in got if r.error]
    kinds = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds[0] == ("urn:page:", "revisit", "urn:page:1", 200_000) and kinds[1] == ("urn:page:1", "response", None, 200_000)
    assert {k[1:3] for k in kinds if k[0] == "urn:page:2"} == {("revisit", "urn:page:1")}
    assert all(k[1] == "response" for k in kinds[4:])
    digest = hashlib.sha256(big.encode()).hexdigest()
    assert all(r.payload_digest == digest for r in got if r.payload_bytes == 200_000)
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).count() == 0


def test_warc_reader_goes_on_after_damage():
    members = [warc.record_bytes(f"urn:page:{i}", "u", bytes([65 + i]) * 5000, None) for i in range(4)]
    wrong = bytearray(zlib.decompress(members[1], 31))
    wrong[-100] ^= 1
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    members[1] = squeeze.compress(bytes(wrong)) + squeeze.flush()
    members[2] = members[2][:40] + b"\0\0\0\0" + members[2][44:]
    got = list(warc.records(io.BytesIO(b"".join(members) + b"trailing"), keep_payload=True))
    assert "digest" in got[1]["error"] and [r["record_id"] for r in got if not r["error"]] == ["urn:page:0", "urn:page:3"]
    assert got[0]["payload"] == b"A" * 5000


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        got = super().read(size)
        self.taken += len(got)
        return got


def test_warc_reader_reads_every_byte_once():
    draw = random.Random(14)
    bodies = [draw.randbytes(draw.choice([0, 1, 300, 5000, 70_000, 200_000])) for _ in range(200)] + [b"\0" * 3_000_000]
    members = [warc.record_bytes(f"urn:page:{i}", "u", body, None) for i, body in enumerate(bodies)]
    source = Counted(b"".join(members))
    got = list(warc.records(source, keep_payload=True))
    assert [r["payload"] for r in got] == bodies and not [r for r in got if r["error"]]
    assert [r["offset"] for r in got] == [sum(map(len, members[:i])) for i in range(len(members))]
    assert source.taken == len(source.getvalue())
    assert list(warc.records(io.BytesIO(b""))) == []


def test_simhash_equals_all_pairs(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(30)]
    fps = base + [f ^ sum(1 << b for b in draw.sample(range(64), k)) for f in base for k in (1, 3, 4, 5, 8, 9)] + [0, 1, 3]
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long")
    for distance, limit in ((4, 2048), (8, 3)):
        nodes = sorted(set(fps))
        links = [(i, j) for i in range(len(nodes)) for j in range(i) if (nodes[i] ^ nodes[j]).bit_count() <= distance]
        want = plain_components(len(nodes), links)
        found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.hamming_links(frame, distance, limit=limit).collect()]
        at = {f: i for i, f in enumerate(nodes)}
        assert all((a ^ b).bit_count() <= distance for a, b in found)
        assert plain_components(len(nodes), [(at[a], at[b]) for a, b in found]) == want


def test_simhash_of_odd_texts(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(TEXTS) + 5
    of = {r.id: r for r in got if r.id not in (None, 4)}
    assert of[0].fp == of[1].fp == of[2].fp == 0 and {of[i].component for i in range(3)} == {0}
    assert of[5].component == 4 and of[7].component == 6
    assert [r.component for r in got if r.id is None and r.fp != 0] == [4]
    assert all(r.fp % (1 << 64) == fingerprint(TEXTS[r.id]) for r in of.values())
    kept = simhash.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and 5 not in [r.doc_id for r in kept.collect()]
    assert simhash.near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_forest_keeps_the_nearest():
    draw = np.random.default_rng(8)
    for n, m in ((1, 0), (2, 1), (50, 30), (50, 400)):
        left, right = draw.integers(0, n, m), draw.integers(0, n, m)
        a, b = meetings.forest(n, left, right)
        links = list(zip(left.tolist(), right.tolist(), strict=True))
        root, kept = list(range(n)), []
        for x, y in links:  # Kruskal: links in order, those that join two groups
            if root[x] != root[y]:
                kept.append((x, y))
                root = [root[x] if r == root[y] else r for r in root]
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(kept)


def test_near_copies_equal_all_pairs(spark):
    draw, words = random.Random(12), [f"word{i}" for i in range(3000)]
    texts = []
    for _ in range(40):
        base = draw.choices(words, k=draw.randint(60, 300))
        texts.append(base)
        for edits in (1, 2, 3, 5, 8, 12, 20):
            changed = list(base)
            for at in draw.sample(range(len(base)), edits):
                changed[at] = draw.choice(words)
            texts.append(changed)
    texts = [" ".join(t) for t in texts] + ["", "one two", "one  TWO", None, " "]
    own = [set(fingerprints.shingle_set(t, 5).tolist()) for t in texts]
    share = {(i, j): len(own[i] & own[j]) / max(1, len(own[i] | own[j])) for i in range(len(own)) for j in range(i) if own[i] & own[j]}
    want = plain_components(len(texts), [pair for pair, s in share.items() if s >= 0.8] + [(320, 323), (320, 324)])
    for limit in (2048, 5):
        docs = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0])], "doc_id long, text string")
        got = {r.id: r.component for r in simhash.near_copies(docs, limit=limit).collect()}
        assert set(got) == set(range(len(texts))) and all(want[got[i]] == want[i] for i in got)  # no wrong link
        # a pair of exactly 0.8 meets in one of the six segments with a chance of 0.94
        assert sum(got[i] != want[i] for i in got) <= 0.06 * sum(want[i] != i for i in got)
    rows = odd_docs(spark)
    kept = simhash.keep_one(rows).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == sorted((i is None, i) for i in [0, 3, 4, 6, 8, 9, None, None])
    assert simhash.near_copies(rows.limit(0)).count() == 0 and simhash.keep_one(rows.limit(0)).count() == 0


def test_near_copies_by_the_cosine_of_their_sets(spark):
    draw, words = random.Random(31), [f"word{i}" for i in range(5000)]
    texts = []
    for _ in range(60):
        base = draw.choices(words, k=draw.randint(80, 400))
        texts.append(" ".join(base))
        changed = list(base)
        for at in range(draw.randrange(25), len(base), draw.choice([20, 30, 35, 60])):  # an edit every few dozen words
            changed[at] = draw.choice(words)
        texts.append(" ".join(changed))
        texts.append(" ".join(base[: len(base) // 2] + draw.choices(words, k=len(base) // 2)))  # half of it is no copy
    own = [set(fingerprints.shingle_set(t, 5).tolist()) for t in texts]
    links = [(i, j) for i in range(len(own)) for j in range(i) if len(own[i] & own[j]) >= 0.8 * (len(own[i]) * len(own[j])) ** 0.5]
    want = plain_components(len(texts), links)
    for limit in (2048, 4):
        got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), measure="cosine", limit=limit).collect()}
        assert all(want[got[i]] == want[i] for i in got)
        assert sum(got[i] != want[i] for i in got) <= 0.1 * sum(want[i] != i for i in got) and len(links) > 30
    with pytest.raises(ValueError, match="no measure"):
        simhash.near_copies(spark.createDataFrame([], "doc_id long, text string"), measure="overlap")


def test_near_copies_inside_a_large_family(spark):
    """1,500 texts share a passage (0.6 to 0.79 alike); 40 of them have a true copy that is not their nearest in bits."""
    draw, passage = random.Random(21), [f"shared{i}" for i in range(254)]
    own = [[f"own{i}x{k}" for k in range(50)] for i in range(1500)]
    texts = [passage + o for o in own]
    for i in range(40):  # the passage stays, 20 of the 50 own words end otherwise: 0.87
        texts.append(passage + own[i][:30] + [f"new{i}x{k}" for k in range(20)])
    order = draw.sample(range(len(texts)), len(texts))
    sets = [set(fingerprints.shingle_set(" ".join(t), 5).tolist()) for t in texts]
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(share(i, 1500 + i) >= 0.8 for i in range(40)) and all(0.6 <= share(*draw.sample(range(1500), 2)) < 0.8 for _ in range(200))
    docs = spark.createDataFrame([(i, " ".join(texts[j])) for i, j in enumerate(order)], "doc_id long, text string")
    at = {j: i for i, j in enumerate(order)}
    got = {r.id: r.component for r in simhash.near_copies(docs).collect()}
    assert [i for i in range(40) if got[at[i]] != got[at[1500 + i]]] == []
    assert len(set(got.values())) == 1500  # and no two others


def test_near_copies_of_equal_fingerprints_are_compared(spark):
    """Texts that share a line repeated 100 times and nothing else are no copies; equal shingle sets in other order are."""
    line = " ".join(["again and again and over"] * 100)
    texts = [line + " " + " ".join(f"own{i}x{k}" for k in range(520)) for i in range(20)]
    texts += ["a b c d e " * 3 + "a b c d", "a b c d e " * 30 + "a b c d", texts[3] + " end", texts[3].upper()]
    got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(21)} | {21: 20, 22: 3, 23: 3}


def test_chat_rotation_in_parts(spark):
    rows = [(1, 2, "user", "b<|im_end|>", "x"), (1, 0, "system", "s", "x"), (1, 1, None, None, "x"), (1, 3, "user", "c", "x"), (1, 3, "user", "c", "x"), (None, 0, "user", "n", "x"), (2, None, "system", "only", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rank string")
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(turns, turns_per_part=3).collect()}
    assert set(got) == {(1, "user", 0), (1, "user", 1), (1, "unnamed", 0), (1, "unnamed", 1), (None, "user", 0)}
    first = got[1, "user", 0]
    assert first.text == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user name=unnamed\n<|im_end|>\n<|im_start|>assistant\nb<| im_end |><|im_end|>\n"
    assert [first.text[m.start:m.end] for m in first.masks] == ["b<| im_end |><|im_end|>"]
    assert [got[1, "user", 1].text[m.start:m.end] for m in got[1, "user", 1].masks] == ["c<|im_end|>"] * 2
    assert sum(r.n_turns for k, r in got.items() if k[:2] == (1, "user")) == 5
    assert chat.rotate(turns.limit(0)).count() == 0


def test_urls_rules_and_templates(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]
    named = ["http://Example.COM/en/1", "https://www.example.com/en/1?x", "http://a.com/x", "http://notexample.com/en/", "http://x.org", None, "no scheme", "://h.org/a#b://c"]
    rows = [(i, u, None) for i, u in enumerate(named)]
    rows += [(100 + i, f"http://m.org/bad/{i}.html", 0) for i in range(40)] + [(200 + i, f"http://m.org/good/{i}", 1) for i in range(40)]
    rows += [(300, f"http://m.org/bad/{'x/' * 30}", None), (300, "http://m.org/good/7", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    got = urls.judge(pages, rules).collect()
    of = {r.page_id: r for r in got if r.page_id != 300}
    assert len(got) == len(rows)
    assert [(of[i].host, of[i].path, of[i].rule, of[i].verdict) for i in range(4)] == [
        ("example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("a.com", "/x", "com/", "allow"), ("notexample.com", "/en/", "com/", "allow")]
    assert [(of[i].host, of[i].path) for i in (4, 5, 6, 7)] == [("x.org", ""), ("", ""), ("", ""), ("h.org", "/a")]
    assert of[100].template == "/bad/*" and {of[100 + i].verdict for i in range(40)} == {"block"}
    assert {of[200 + i].verdict for i in range(40)} == {"allow"}
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_urls_reject_against_the_base_rate_and_below_eight_levels(spark):
    rows = [(i, f"http://big.org/fine/{i}", int(i % 10 > 0)) for i in range(1000)]  # 10 % bad
    rows += [(2000 + i, f"http://big.org/poor/{i}", int(i % 20 > 8)) for i in range(100)]  # 45 % bad
    rows += [(2200, "http://few.org/a/1", 0), (2201, "http://one.org/1", 0), (2202, "http://one.org/2", 0)]  # too few to tell
    deep = "/".join(f"d{k}" for k in range(10))
    rows += [(3000 + i, f"http://deep.org/{deep}/{'bad' if i < 30 else 'good'}/{i}", int(i >= 30)) for i in range(60)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, label int"), []).collect()}
    assert len(got) == len(rows)
    blocked = {i for i, r in got.items() if r.verdict == "block"}
    assert blocked == {2000 + i for i in range(100)} | {3000 + i for i in range(30)}
    assert {got[3000 + i].template.split("/")[-2:] == ["bad", "*"] for i in range(30)} == {True}


@pytest.mark.parametrize("chunk,overlap", [(16, 4), (60, 8), (100, 3), (1 << 15, 256)])
def test_long_texts_are_spliced_exactly(chunk, overlap):
    draw = random.Random(chunk)
    bits = ["a", "b", " ", "  ", "\n", "\n\n", "é", "1", "23", "'s", "'", "!", "...", "<|endoftext|>", "<|end", "\x1c", "\x85", "\u3000", "中文", "😀", "\t", "word", " the"]
    whole, library = tokens.tokenizer(JSON), bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for n in range(60):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(1, 300))) + ("a" * 500 if n % 7 == 0 else "") + (" " * 300 if n % 5 == 0 else "")
        assert tokens.count_one(JSON, text, chunk, overlap) == len(whole.encode(text, add_special_tokens=False).ids)
        assert bpe.encode_long(RANKS, public_tokenizers.PATTERN, text, chunk, overlap) == np.array(library.encode_ordinary(text), "<u4").tobytes()
    joined = "".join("".join(p[a:b]) for p, a, b in splicing.spliced(LONG, lambda t: (list(range(len(t) + 1)), t), 100, 40))
    assert joined == LONG


def test_token_counts_and_ids_of_odd_texts(spark):
    docs = odd_docs(spark)
    counts = tokens.count_tokens(docs, JSON).collect()
    whole = tokens.tokenizer(JSON)
    assert {(r.id, r.n_tokens) for r in counts if r.id not in (None, 4)} == {
        (i, len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(TEXTS) if i != 4}
    assert len(counts) == len(TEXTS) + 5 and tokens.count_tokens(docs.limit(0), JSON).count() == 0
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.encoding(RANKS, public_tokenizers.PATTERN)._mergeable_ranks, special_tokens={})
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    both = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, back)) and len(both) == len(TEXTS) + 5
    for r in (r for r in both if r.doc_id not in (None, 4)):
        text = TEXTS[r.doc_id] or ""
        assert bytes(r.decoded) == text.encode() and np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN, decoded=True).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(40, 40), (100, 50), (257, 33)])
def test_chunks_as_rows_are_stitched_exactly(spark, chunk, overlap):
    draw = random.Random(chunk)
    bits = ["a", "b", " ", "  ", "\n", "\n\n", "é", "1", "23", "'s", "!", "...", "<|endoftext|>", "\x1c", "\x85", "\u3000", "中文", "😀", "\t", "word", " the", " longer words"]
    texts = ["".join(draw.choices(bits, k=draw.choice([3, 40, 300, 900]))) + ("a" * 500 + " b" * 90 if n % 7 == 0 else "") + (" " * 300 + "c" if n % 5 == 0 else "") for n in range(80)]
    texts += ["x" * (chunk + overlap + d) for d in (-1, 0, 1)] + [" y" * chunk, LONG, None, "", texts[0]]
    docs = spark.createDataFrame([(i, t, {"k": i}, "n") for i, t in enumerate(texts)], "doc_id long, text string, row map<string,int>, document string")
    library = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = bpe.encode(docs.repartition(3), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, decoded=True).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text) and bytes(r.decoded).decode() == text
        assert r.n_tokens == len(r.ids) // 4 and r.row == {"k": r.doc_id} and r.document == "n"
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=30, overlap=31)


def test_common_border_is_the_last_that_proves_something():
    earlier, later = np.array([0, 90, 100, 105, 118, 140, 150]), np.array([0, 5, 18, 40, 60])
    assert bpe.common_border(earlier, later, 100, 150) == (4, 2)  # 140 lies among the last 32 characters
    assert bpe.common_border(np.array([0, 101, 150]), later, 100, 150) is None


def plain_figures(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_remembered_pre_tokens_count_as_the_library_counts():
    draw, signs = random.Random(5), [*map(chr, range(0x250)), *" \t\n\x1c\x85'slt1!" * 20, "<|endoftext|>", "日"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(4000)] + ["=" * 500, ""]
    whole = [len(e) for e in tokens.tokenizer(JSON).encode_batch(texts, add_special_tokens=False)]
    for cut in (True, False):
        assert tokens.count_short(JSON, texts, cut) == whole
    assert tokens.byte_level(JSON) and max(map(len, tokens._known[JSON])) <= tokens.PIECE_CHARS


def test_quality_figures_and_line_limits(spark):
    draw = random.Random(9)
    texts = [None, "", "a b c a b c", "a a a a a", "#x *y|\n \n#x *y|\nz", "\u00a0 é\u2003è"] + [" ".join(draw.choice("abc") for _ in range(draw.randint(1, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(2, texts[2])], "doc_id long, text string").selectExpr("*", "'s' as source", "1 as row", "1 as lines")
    got = quality.judge(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_figures(texts[r.doc_id])
    own = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(30)]
    shared = " ".join(f"s{k}" for k in range(70))
    rows = [(i, f"{t}\n{shared}", "h") for i, t in enumerate(own)] + [(100, f"{own[0]} new", "h"), (101, shared, None)] + [(200 + i, "copy " + own[1], "h") for i in range(30)]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_documents=5).collect()}
    assert judged[0].kept and not any(judged[i].kept for i in range(1, 30))  # the line holds 70 of 130 words; document 0 keeps it
    assert judged[100].kept and judged[101].kept and all(judged[200 + i].kept for i in range(30))
    kept = quality.keep_good(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and sorted(r.doc_id for r in kept.collect()) == [6, 6, 7]
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_removes_the_lines_over_the_limit(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"{own(i)}\n\n  Shared LINE {i % 2}\nlast {i}", "h", 0, "k") for i in range(30)]
    rows += [rows[7], (50, own(50), "h", 5, "k"), (51, f"{own(51)}\nshared line 1", "rare", 5, "k"), (None, f"{own(52)}\nshared line 0", "h", 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, row string")
    got = quality.keep_good(docs, min_documents=10)
    assert got.schema == docs.schema
    got = got.collect()
    want = {i: f"{own(i)}\n\nlast {i}" if i > 1 else rows[i][1] for i in range(30)} | {50: own(50), 51: f"{own(51)}\nshared line 1", None: own(52)}
    assert len(got) == len(rows) and all(r.text == want[r.doc_id] for r in got)  # 0 and 1 keep the lines
    assert all(r.n_chars == (len(r.text) if r.doc_id is None or 1 < r.doc_id < 50 else {50: 5, 51: 5}.get(r.doc_id, 0)) for r in got)


def test_quality_rejects_by_the_shipped_limits_in_a_hot_source(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    licence = " ".join(f"l{k}" for k in range(70))
    rows = [(i, own(i) + (f"\n{licence}" if i < 25 else ""), "hot") for i in range(4000)]  # 0.6 % of the source hold the line
    rows += [(5000 + i, f"{own(5000 + i)}\n{licence}", "small") for i in range(20)]  # the limit itself is not over it
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert sorted(i for i, r in got.items() if not r.kept) == list(range(1, 25))


def test_pipeline_removes_rare_lines_of_a_hot_source(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, own(i) + ("\nnavigation line" if i < 25 else "") + ("\nrare line" if i % 200 == 0 else ""), "hot") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert len(got) == 4000 and [i for i, t in got.items() if "navigation" in t] == [0]  # 25 documents, 0.6 % of the source
    assert sum("rare line" in t for t in got.values()) == 20  # not more than 20 documents


def test_classifier_learns_without_the_held_out_fold(spark):
    draw = random.Random(2)
    good = lambda: " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) + draw.choice("abcde") for _ in range(80))
    rows = [(i, good() if i % 4 else good().upper().replace(" ", "!! ")) for i in range(400)] + [(900, None), (901, ""), (902, LONG), (None, "x"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as score", "0 as quality")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)] + [(7, 1, 0), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    got = classifier.classify(docs, labels).withColumn("held", classifier.held_out(docs.doc_id)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held and r.doc_id < 400 and r.text != "again"]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    assert [r.score for r in classifier.classify(docs, flipped).collect()] == [r.score for r in got]
    assert {r.score for r in classifier.classify(docs, labels.limit(0)).collect()} == {0.5} and classifier.classify(docs.limit(0), labels).count() == 0


def test_context_sums_and_pooling_equal_a_plain_version(spark):
    draw = random.Random(17)
    texts = [" ".join(draw.choice(["alpha", "Beta", "c!", "d", "e,f", "日本", "x1"]) + draw.choice(["", "", str(draw.randrange(400))]) for _ in range(draw.randint(0, 90))) for _ in range(120)]
    texts += [None, "", " ", "one", texts[0]]
    tokens_of = [classifier.TOKEN.findall(t or "") for t in texts]
    name = lambda w: xxhash.xxh64_intdigest(w.encode())

    def index(w):
        vector = np.zeros(classifier.DIMS, np.int64)
        for k in range(8):
            vector[name(w) // 128 ** k % 64] += -1 if name(w) // 128 ** k // 64 % 2 else 1
        return vector

    sums, n = {}, {}
    for words in tokens_of:
        for i, w in enumerate(words):
            near = [index(words[j]) for j in range(max(0, i - 2), min(len(words), i + 3)) if j != i]
            sums[name(w)] = sums.get(name(w), 0) + sum(near, np.zeros(classifier.DIMS, np.int64))
            n[name(w)] = n.get(name(w), 0) + 1
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.word % (1 << 64): (r.n, list(r)[2:]) for r in classifier.context_sums(docs).collect()}
    assert got == {w: (n[w], sums[w].tolist()) for w in n}

    least = 5 / sum(n.values())
    vectors = classifier.word_vectors(docs, least_share=least)
    assert vectors.hashes.tolist() == sorted(w for w in n if n[w] >= 5) and len(vectors.hashes) < len(n)
    unit = {w: sums[w] / max(1.0, np.linalg.norm(sums[w])) if n[w] >= 5 else np.zeros(classifier.DIMS) for w in n}
    known = classifier.Words()
    for text, words in zip(texts, tokens_of, strict=True):
        rows = np.array([np.concatenate((index(w) / 8 ** 0.5, unit[name(w)])) for w in words]).reshape(-1, 2 * classifier.DIMS)
        want = np.concatenate((rows.mean(axis=0), rows.std(axis=0))) if len(rows) else np.zeros(classifier.INPUTS)
        assert np.allclose(classifier.features(text, vectors, known), want, atol=1e-4)
    assert len(classifier.word_vectors(docs.limit(0)).hashes) == 0


def test_counted_words_bound_the_context_sums(spark, monkeypatch):
    draw = random.Random(23)
    texts = [" ".join(draw.choice(["the", "Of", "x,y", "日本"]) + draw.choice(["", str(draw.randrange(60))]) for _ in range(draw.randint(0, 70))) for _ in range(90)] + [None, "", "the"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    everything = {r.word: tuple(r) for r in classifier.context_sums(docs).collect()}
    counts = {r.word: r.n for r in classifier.word_counts(docs).collect()}
    assert counts == {w: r[1] for w, r in everything.items()}
    only = np.sort(np.array([w for w, n in counts.items() if n >= 8] + [12345], np.int64).view(np.uint64))
    got = {r.word: tuple(r) for r in classifier.context_sums(docs, only=only).collect()}
    assert got == {w: r for w, r in everything.items() if counts[w] >= 8} and 3 < len(got) < len(counts)
    assert classifier.context_sums(docs, only=only[:0]).count() == 0 and classifier.word_counts(docs.limit(0)).count() == 0
    vectors = classifier.word_vectors(docs, least_share=8 / sum(counts.values()))
    alone = [classifier.features(t, vectors, classifier.Words()) for t in texts]
    for fresh, kept in ((1, 1 << 17), (1 << 12, 40)):  # tables filled text by text, and emptied again and again
        monkeypatch.setattr(classifier, "FRESH_AT_ONCE", fresh)
        monkeypatch.setattr(classifier, "WORDS_KEPT", kept)
        assert np.array_equal(classifier.all_features(texts, vectors, classifier.Words()), alone)


def test_vectors_are_not_looked_up_again_for_words_with_places(monkeypatch):
    hashes = np.sort(classifier.word_hashes(["one", "two", "three"]))
    vectors = classifier.Vectors(hashes, np.arange(3 * classifier.DIMS, dtype=np.float32).reshape(3, -1))
    looked_up, placed = classifier.Words(), classifier.Words(vectors.hashes)
    numbers = [words.numbers("one more two of three") for words in (looked_up, placed)]
    looked_up.settle(), placed.settle()
    want = vectors.of(looked_up, numbers[0])
    assert np.count_nonzero(want[:, classifier.DIMS:].any(axis=1)) == 3
    monkeypatch.setattr(classifier, "positions", None)
    assert np.array_equal(vectors.of(placed, numbers[1]), want)


def test_vectors_reach_most_pairs_and_no_wrong_one(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 24))
    near = np.vstack([c + draw.normal(scale=0.13, size=(draw.integers(1, 40), 24)) for c in centres])
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(near)]
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [float("nan")] * 24, 1), (n + 3, [None] + [1.0] * 23, 1), (n + 4, [], 1), (n + 5, [1.0, 2.0], 1), (n + 6, [1.0, 2.0], 1), (n + 7, rows[0][1], 1), (None, rows[0][1], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, size int")
    exact = near.astype(np.float32).astype(np.float64)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    links = exact @ exact.T >= 0.95
    np.fill_diagonal(links, False)
    for limit in (2048, 7):
        got = vectors.near_duplicates(frame, sample=256, limit=limit).collect()
        of = {r.id: r for r in got}
        assert len(got) == n + len(odd)
        found = sum(of[i].n_links for i in range(1, n)) - 2 * int(links[0, 1:].sum())  # row 0 has two copies
        assert 0.9 <= found / links[1:].sum() and all(of[i].n_links <= links[i].sum() + 2 * links[i, 0] for i in range(1, n))
        assert all(of[n + i].n_links == 0 and of[n + i].kept for i in range(5))
        assert of[n + 5].n_links == of[n + 6].n_links == 1 and of[n + 6].component == n + 5 and of[n + 7].component == of[0].component and not of[None].kept
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def plain_targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1.0, 2.0, 3.0)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing_meets_the_targets(spark):
    draw = random.Random(6)
    counts = {"a": 600, "b": 200, "c": 100, "d": 5, "é": 300, None: 150, "empty": 3}
    rows = [(len(str(s)) * 10_000 + i, " ".join(["w"] * (0 if s == "empty" else draw.randint(1, 80))), s, 5) for s, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame(rows + [(None, None, "a", 1), rows[0]], "doc_id long, text string, source string, n_chars long")
    got = mixing.mix(docs).collect()
    sizes = {s: sum(r.size for r in got if r.source == s) for s in counts}
    want = plain_targets(sizes)
    assert len(got) == len(rows) + 2 and all(r.copies <= 3 and r.taken == r.copies * r.size for r in got)
    for s in counts:
        own = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(want[s]) and r.source_size == sizes[s] for r in own)
        assert sum(r.rate * r.size for r in own) == pytest.approx(want[s], rel=1e-6)
        assert abs(sum(r.taken for r in own) - want[s]) <= 81
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(3)).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0 and {r.taken for r in mixing.mix(docs.where("source = 'empty'")).collect()} == {0}
