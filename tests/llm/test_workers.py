"""What Python workers keep from stage to stage, and short ways in encoding."""

import json

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from codequarry.llm import bpe, chunks, repair

PATH = public_tokenizers.path("byte_bpe_50k.json")


class _Content:
    value = "some content"


def test_release_drops_what_was_built():
    kept = bpe.built("quality", _Content, lambda content: [content])
    assert bpe.built("quality", _Content, lambda content: []) is kept
    bpe.release()
    assert not bpe._BUILT
    bpe.release()


def test_fingerprints_keep_no_vocabulary(spark, monkeypatch):
    """A stage without vocabularies frees what an earlier one left in the worker."""
    from codequarry.llm.simhash import fingerprints

    docs, tasks = spark.createDataFrame([(1, "a b c d"), (2, None)], "doc_id long, text string"), []
    assert {r.doc_id for r in fingerprints(docs).collect()} == {1, 2}
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    fingerprints(docs)
    bpe.built("quality", _Content, lambda content: [content])
    assert list(tasks[0](iter([]))) == [] and not bpe._BUILT


@pytest.mark.parametrize("text", ["", " ", "word", " word", "  word", "Word's", " wörd", "don't stop", "a" * 63, " " + "b" * 80,
                                  "tail ", "x1", "1x", "\nnext", "ﬁ", "<|endoftext|>", "q<|endoftext|>q", "'s", "​ab"])
def test_short_way_gives_the_same_ids(text):
    with open(PATH, encoding="utf-8") as f:
        content = f.read()
    library = Tokenizer.from_str(content)
    assert list(bpe.ByteBPE(content).encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_of_letters_are_still_seen():
    with open(PATH, encoding="utf-8") as f:
        file = json.loads(f.read())
    added = {"id": 60000, "content": "stop", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    file["added_tokens"] = [*file.get("added_tokens", []), added]
    assert 60000 in bpe.ByteBPE(json.dumps(file)).encode(" nonstop")


def test_words_take_the_short_way(monkeypatch):
    """Words need neither the split pattern nor the search for special tokens."""
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.ByteBPE(f.read())
    monkeypatch.setattr(bpe, "split_special", None)
    assert list(encoder.encode(" words")) and chunks.give_back() is None


def test_expansion_lengths():
    pairs = np.array([[1, 2], [10, 3], [11, 10]])
    assert repair.expansion_lengths(pairs, 10).tolist() == [2, 3, 5]
    assert repair.expansion_lengths(np.zeros((0, 2), np.int64), 10).tolist() == []
