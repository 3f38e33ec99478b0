"""Token counts and BPE encoding against the tokenizers library."""

import hashlib
import pickle
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from foliospark.llm import automaton, pretokens, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = ["", " \n\t", "it's they'LL", "a" * 3000, "ha" * 2000, "!" * 2001, "x<|endoftext|>y<|startoftext|>",
         "<|ENDOFTEXT|>", "ΣΑΣ straße ﬁ İ", "日本語のテキスト 😀😀", "é Å", "\x1c\x85  a b", "½²٣ 12"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return automaton.compile(PATH).encoder()


def texts():
    rng = random.Random(5)
    for letters in ("aabbn ", "ha", "lo!?", "tion the ing", "0123 .,-'", "éàßñ ück"):
        for _ in range(60):
            yield "".join(rng.choice(letters) for _ in range(rng.randint(1, 50)))
    for code in [*range(0x530), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), 0x3042, 0x430, 0x1F600, 0x558]:
        yield f"a{chr(code)}1 {chr(code)}s'{chr(code)}"
    yield from EDGES


def test_automaton_equals_library(library, encoder):
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.text(text) == ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_one_label_may_end_each_beginning(encoder):
    """The transitions leave no choice: of the labels that end at a place one continues a path."""
    a, rng = encoder.a, random.Random(6)
    inner = {t: i for t, i in a.ids.items() if not t.endswith(a.suffix)}
    for word in ["".join(rng.choice("aehlnorst") for _ in range(rng.randint(1, 14))) for _ in range(300)]:
        last = {0: None}
        for end in range(1, len(word) + 1):
            ways = [inner[word[s:end]] for s in range(end) if word[s:end] in inner and (last[s] is None or not a.table[
                a.row[last[s]], a.column[inner[word[s:end]]] >> 3] >> (a.column[inner[word[s:end]]] & 7) & 1)]
            assert len(ways) == 1
            last[end] = ways[0]


def test_memory_keeps_the_newer_half(library, encoder, monkeypatch):
    monkeypatch.setattr(automaton, "REMEMBERED", 50)
    monkeypatch.setattr(automaton, "TOGETHER", 64)
    given = list(texts())
    for at in range(0, len(given), 7):
        found = [np.frombuffer(b"".join(x[1] for x in entries), np.int32).tolist() for entries in encoder.batch(given[at:at + 7])]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in given[at:at + 7]]


def test_rank_merging_equals_library(library):
    given = list(texts())
    counter = token_counts.Counter(token_counts.Ranks(pretokens.read(PATH)))
    assert counter.counts(given) == [len(library.encode(t, add_special_tokens=False).ids) for t in given]


def test_long_words_by_buckets(library):
    """The same counts as the library, whatever the length; a megabyte takes seconds."""
    import time
    ranks, rng = token_counts.Ranks(pretokens.read(PATH)), random.Random(7)
    for letters, sizes in (("aab", (1, 60)), ("the ing".replace(" ", ""), (1, 300)), ("abcdefghijklmnopqrstuvwxyz", (1, 300)), ("é日a", (1, 100)), ("!?", (1, 90))):
        for _ in range(80):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(*sizes)))
            assert token_counts.merge_long(word.encode(), ranks) == token_counts.merge([word.encode()], ranks)[0], word
    for word in ("a" * 5000, "ha" * 4000, "".join(rng.choice("aehlnorst") for _ in range(20_000))):
        assert token_counts.Counter(ranks).counts([word, f"{word} {word}!"]) == [
            len(library.encode(t, add_special_tokens=False).ids) for t in (word, f"{word} {word}!")]
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    started = time.process_time()
    token_counts.Counter(ranks).counts([word, "a" * 1_000_000])
    assert time.process_time() - started < 20


def test_gadgets_on_a_small_grammar():
    vocabulary = pretokens.Vocabulary({x: i for i, x in enumerate(["a", "b", "aa", "ab", "aab", "aaaa"])},
                                      [("a", "a"), ("a", "b"), ("aa", "b"), ("aa", "aa")], {}, "</w>")
    state, column, missing = automaton._gadgets(vocabulary)

    def follows(x, y):
        return not missing[state[x], column[y]]
    assert not follows("a", "a") and not follows("a", "aa") and follows("aa", "a")
    assert not follows("a", "b") and not follows("aa", "b") and not follows("aa", "aa")
    assert follows("aaaa", "ab") and follows("b", "aab")


def test_table_is_made_in_its_own_size():
    """The driver makes it: a byte for each of its bits would be 160 MB there."""
    import tracemalloc
    tracemalloc.start()
    try:
        made = automaton.compile(PATH)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made.table.flags.c_contiguous and made.table.nbytes < 21 << 20 and most < 120 << 20, most


def test_broadcast_is_small(encoder):
    """The driver and each executor hold its blocks as long as the broadcast lives."""
    sent = pickle.dumps(encoder.a)
    got = pickle.loads(sent)
    assert len(sent) < 8 << 20 and (got.table == encoder.a.table).all() and vars(got).keys() == vars(encoder.a).keys()
    assert got.encoder().text("the cat sat") == encoder.text("the cat sat")


def test_tables(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (3, "the cat", "z"), (3, "the cat", "z"), (None, "a b", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, token_counts.count(docs, PATH, limit=1).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (3, 7, 2, True), (3, 7, 2, True), (None, 3, 2, True)], key=str)
    encoded = automaton.encode(docs, PATH)
    assert {r.doc_id: r.ids for r in encoded.collect()}[3] == library.encode("the cat", add_special_tokens=False).ids
    assert sorted(r.decoded for r in automaton.decode(encoded, PATH).collect()) == ["", "", "a</w> b</w>"] + ["the</w> cat</w>"] * 2
    digest = {r.doc_id: r for r in automaton.encode(docs, PATH, keep_ids=False).collect()}
    assert digest[1].n_tokens == 0 and digest[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    empty = docs.where("false")
    assert token_counts.count(empty, PATH).count() == automaton.encode(empty, PATH).count() == 0
