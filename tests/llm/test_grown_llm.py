"""Memory and time that grew with the run: what training leaves on the driver, lanes of a token file."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality, tokenfile, toxicity
from tidemark.llm.queries import vocab


def test_training_gives_memory_back(spark, monkeypatch):
    """The driver trains before other stages run; what it used must not stay beside them."""
    given = []
    for module in (quality, toxicity):
        monkeypatch.setattr(module, "give_back", lambda name=module.__name__: given.append(name))
    docs = spark.createDataFrame([(i, f"word{i} of a text that is {'nasty' if i % 2 else 'kind'} number {i}") for i in range(60)], "doc_id long, text string")
    quality.fit(docs)
    toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert given == [quality.__name__, toxicity.__name__]


def test_token_files_are_half_as_many_as_partitions(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(64)], "doc_id long, text string")
    files = tokenfile.write_table(docs, vocab("byte_bpe_50k.json"), 2)
    assert files.count() <= int(spark.conf.get("spark.sql.shuffle.partitions")) // 2
    got = tokenfile.read_table(files).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == list(range(64)) and [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()


def test_class_counts_stay_in_a_byte():
    ids = np.zeros(5000, dtype="<u2")  # one class is hit at every step
    assert np.array_equal(tokenfile.read_file(tokenfile.write_file(np.array([1]), np.array([5000]), ids))[2], ids)
    assert tokenfile.Lanes(1, *tokenfile.lookup(*tokenfile.share_table(ids.astype(np.int64)))).cum.itemsize == 1


def test_a_lane_of_a_token_file_is_small():
    """Contexts are one table of the file; a table for each block left the caches and cost most of the coder's time."""
    ids = np.arange(64, dtype="<u2")
    lanes = tokenfile.Lanes(1000, *tokenfile.lookup(*tokenfile.share_table(ids.astype(np.int64))))
    lanes.predict()
    assert max(a.nbytes for a in vars(lanes).values() if isinstance(a, np.ndarray)) <= 1 << 18


def test_every_block_starts_from_the_contexts_of_its_file():
    order = np.random.default_rng(5).permutation(2000)
    ids = np.tile(order, 20).astype("<u2")  # no id comes twice within a block, so a block alone can't foresee any
    data = tokenfile.write_file(np.array([1]), np.array([len(ids)]), ids)
    assert len(data) < len(ids)  # order 0 alone: 11 bits an id
    assert np.array_equal(tokenfile.read_file(data)[2], ids)
    assert np.array_equal(tokenfile.read_block(data, 7), ids[7 * tokenfile.BLOCK : 8 * tokenfile.BLOCK])


def test_carries_run_on_to_the_words_before():
    words = np.array([7, 0xFFFF, 0xFFFF, 3, 0xFFFF, 9], dtype=np.uint16)
    tokenfile.carry(words, np.array([2, 4]))
    assert words.tolist() == [8, 0, 0, 4, 0, 9]


def test_texts_encoded_together_equal_texts_encoded_alone():
    odd = ["", " ", "a", " a", "a ", "a  b", "a b", "b a b c'd 's 've", "x  y", "x  y", "p \x1cq", "　 z z", "one\ntwo three\n", "three \nfour", "s <|endoftext|> a b", "<|endoftext|>", "a <| b", "́ ́x \U0001f600 a", "l" * 3000 + " a", " ".join("abcab")]
    for most in (1_200_000, 3):
        enc = tokenfile.ByteBPE(vocab("byte_bpe_50k.json"), most=most)
        for texts in (odd, odd[::-1], [], [""], odd[5:9]):
            lengths, ids = enc.encode_many(texts, 2)
            ends = np.cumsum(lengths)
            want = [enc.encode(t) + b"\2\0" for t in texts]
            assert [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())] == want and len(ids) == sum(map(len, want)) // 2
        assert most > 3 or not len(enc.known)


def test_files_end_at_the_document_that_reaches_the_limit(spark):
    docs = spark.createDataFrame([(i, "a b c d " * (i % 3)) for i in range(40)], "doc_id long, text string").coalesce(1)
    files = tokenfile.write_table(docs, vocab("byte_bpe_50k.json"), 2, most_tokens=20)
    sizes = [r["n_tokens"] for r in files.collect()]
    rows = tokenfile.read_table(files).orderBy("doc_id").collect()
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist() and len(rows) == 40
    assert max(sizes) < 20 + max(r["n_tokens"] for r in rows) and len(sizes) > 4
