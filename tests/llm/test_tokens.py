import public_tokenizers
from common import MIDDLE, edge_frame, empty_frame, table
from shotframe.llm import bpe
from tokenizers import Tokenizer

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
HARD = ["a<|endoftext|>b <|startoftext|>", "ΑΣ ΣΑΣ", "ﬁ½²ⅷ 'S it's", "İx \x1c\x1d y\x85z​q", "", " ", "#" * 3000, "a" * 5000,
        "日本語 émoji 😀😀", "don't'll'd", "é́", "<|endoftext|", "ſs's'ſ", "x　y z"]


def test_equals_the_library(spark):
    lib = Tokenizer.from_file(PATH)
    texts = [r["text"] for r in table("documents", MIDDLE)] + HARD
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in bpe.token_counts(df, PATH).collect()}
    for k, (text, said) in enumerate(zip(texts, lib.encode_batch(texts, add_special_tokens=False))):
        assert (got[k].n_tokens, got[k].n_bytes) == (len(said.ids), len(text.encode())), text[:60]
        assert got[k].over_limit == (len(said.ids) > 2048)


def test_edge_rows(spark):
    got = bpe.token_counts(edge_frame(spark), PATH).collect()
    assert len(got) == 14
    assert {(r.n_bytes, r.n_tokens) for r in got if r.doc_id in (4, 5)} == {(0, 0)}
    assert bpe.token_counts(empty_frame(spark), PATH).collect() == []


def test_merges_by_rank_leftmost_first():
    ranks = {("a", "a"): 0, ("aa", "a"): 1}
    assert bpe.merges_needed(list("aaa"), ranks) == 2
    assert bpe.merges_needed(list("aaaa"), ranks) == 2
    assert bpe.merges_needed([], ranks) == bpe.merges_needed(["a"], ranks) == 0
