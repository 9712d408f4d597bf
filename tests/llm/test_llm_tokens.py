from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from llm_helpers import clashing, documents, words
from tokenizers import Tokenizer

from floorline.llm.token_files import KEPT_WORDS, VOCABULARY, WordEncoder, occurrences, read_token_files, write_token_files
from floorline.llm.wavelet import WaveletMatrix, from_bytes, to_bytes
from floorline.streaming.workspace import shared_folder

ODD = ["It's <|endoftext|> or don't 12a b3,, \x1c z  --", "ÉÀ İß é   日本語", "Hello, WORLD!! (yes)", "", None]


def test_files_give_back_the_tokenizers_ids(spark):
    texts = [(k, " ".join(words(k, 300, 5000))) for k in range(40)] + [(100 + k, t) for k, t in enumerate(ODD)]
    texts += [(7, "same id"), (None, "no id"), (-5, "negative id"), (200, " ".join(words(1, 20_000, 10 ** 6)))]
    folder = shared_folder(spark, "tokens-test")
    manifest = write_token_files(clashing(documents(spark, *texts)), folder, shard_bytes=20_000).collect()
    assert len(manifest) > 3 and sum(r["documents"] for r in manifest) == len(texts)
    found = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    order = [r["doc_id"] for r in found]
    assert order == [None, *sorted(i for i, _ in texts if i is not None)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sorted((str(i), tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in texts)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == wanted
    at = 0
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    # Counting and finding from the files alone.
    token = int(np.frombuffer(found[5]["ids"], "<u4")[0])
    every = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in found])
    looked = occurrences(spark, folder, token).collect()
    before = dict(zip(sorted(r["shard"] for r in manifest), np.r_[0, np.cumsum([r["tokens"] for r in sorted(manifest, key=lambda r: r["shard"])])]))
    places = sorted(int(before[r["shard"]]) + p for r in looked for p in r["places"])
    assert places == np.flatnonzero(every == token).tolist() and sum(r["n"] for r in looked) == len(places)


def test_rows_of_one_id_or_none_fill_several_shards(spark):
    texts = [(i, " ".join(words(k, 100, 5000))) for k, i in enumerate([None] * 60 + [7] * 60 + [3, 9])]
    folder = shared_folder(spark, "tokens-test")
    manifest = write_token_files(documents(spark, *texts).repartition(4), folder, shard_bytes=6000).collect()
    assert len(manifest) > 4 and max(r["documents"] for r in manifest) < 40
    found = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None] * 60 + [3] + [7] * 60 + [9]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sorted((str(i), tokenizer.encode(t, add_special_tokens=False).ids + [1]) for i, t in texts)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == wanted


def test_empty_table(spark):
    folder = shared_folder(spark, "tokens-test")
    assert write_token_files(documents(spark), folder).count() == 0


def test_wavelet_matrix_against_the_sequence():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 4000):
        sequence = rng.integers(0, 300, n).astype(np.uint16)
        matrix = from_bytes(to_bytes(np.array([5]), np.array([n]), WaveletMatrix.of(sequence, 16), np.array([False])))[2]
        assert (matrix.all(np.uint16) == sequence).all() and (matrix.access(np.arange(n)) == sequence).all()
        for symbol in (0, 7, 299, 65_535, 70_000):
            assert matrix.count(symbol) == (sequence == symbol).sum()
            assert (matrix.find(symbol) == np.flatnonzero(sequence == symbol)).all()
            assert matrix.count(symbol, n // 3, n) == (sequence[n // 3:] == symbol).sum()


def test_words_with_common_parts_go_through_the_tokenizer_once():
    """Parts of plain words are tokenized once, whatever marks follow and in whichever call they come first."""
    encoder, asked = WordEncoder(public_tokenizers.path(VOCABULARY)), []

    class Model:
        def tokenize(self, text, model=encoder.model):
            asked.append(text)
            return model.tokenize(text)

    encoder.model = Model()
    texts = ["Écoute, écoute! a1 \x1c <|endoftext|>", "", "écoute (écoute) écoute, aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", " \n\v écoute! \f a1,\r\tù  "]
    whole = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for some in ([0, 1], [2], [3], [], [0, 3, 1]):
        ids, counts = encoder.encode(pa.array([texts[k] for k in some], pa.string()))
        wanted = [whole.encode(texts[k], add_special_tokens=False).ids + [1] for k in some]
        assert ids.tolist() == sum(wanted, []) and counts.tolist() == [len(w) for w in wanted]
    # Two spellings of one word, two marks, and a word of one letter.
    assert len(asked) == 5 and encoder.number.settled == len(encoder.number) < KEPT_WORDS
