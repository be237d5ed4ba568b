"""Which words go to the tokenizer's model straight away, and that their ids are those of whole texts."""

import random
import shutil
import string

import numpy as np
import tokenizers

from postlens.llm import queries, token_files

PATH = queries.tokenizer_path("word_bpe_49k.json")


def test_ids_of_words_with_any_punctuation():
    draw, whole = random.Random(0), tokenizers.Tokenizer.from_file(PATH)
    parts = [*string.punctuation, "...", "$$$", "'s", "'", "’", "́", "a", "é", "É", "E", "7", "½", "ß", "ﬁ", "日本", "İ", "\x00", "\x1c", "\x85", "word", "naïve"]
    parts += ["<|endoftext|>", "<|", "|>"]
    words = ["".join(draw.choices(parts, k=draw.randint(1, 5))) for _ in range(20_000)]
    texts = [" ".join(words[i : i + 20]) for i in range(0, len(words), 20)] + ["", " \n", "a\n\nb,\tb"]
    encode = token_files.word_encoder(PATH, 2)()
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], encode(texts[at : at + 100])):
            assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]
            assert ids.dtype == np.dtype("<u4")


def test_letters_before_punctuation_skip_the_pipeline(monkeypatch, tmp_path):
    made, real = [], tokenizers.Tokenizer.from_file(PATH)

    class Counted:
        model, get_added_tokens_decoder = real.model, real.get_added_tokens_decoder

        @classmethod
        def from_file(cls, path):
            return cls()

        def encode(self, text, **options):
            made.append(text)
            return real.encode(text, **options)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    path = str(tmp_path / "copy.json")
    shutil.copy(PATH, path)
    words = [f"{w}{tail}" for w in ("the", "naïve", "été", "straße") for tail in ("$$$", "***", ",&&&", ".%%%", "'")]
    (ids,) = token_files.word_encoder(path, 2)()([" ".join(words)])
    assert ids[:-1].tolist() == real.encode(" ".join(words), add_special_tokens=False).ids
    # Only the tails, each of them once.
    assert sorted(made) == ["$$$", "'", "***", ",&&&", ".%%%"]


def test_a_worker_loads_a_tokenizer_once(monkeypatch, tmp_path):
    path = str(tmp_path / "again.json")
    shutil.copy(PATH, path)
    loads, real = [], tokenizers.Tokenizer.from_file

    class Counted:
        @staticmethod
        def from_file(path):
            loads.append(path)
            return real(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    build = token_files.word_encoder(path, 2)
    assert [build()(["a b", ""])[0].tolist() for _ in range(3)] == [build()(["a b"])[0].tolist()] * 3
    assert loads == [path]


def test_long_texts_are_cut_a_few_at_a_time(monkeypatch):
    assert list(token_files._bounded(["aaa", "b", "", "cccccc", "d"], 4)) == [["aaa", "b", ""], ["cccccc"], ["d"]]
    assert list(token_files._bounded([], 4)) == []
    texts = ["the end, of it", "", "été " * 9, "the <|endoftext|> X"]
    want = [x.tolist() for x in token_files.word_encoder(PATH, 2)()(texts)]
    monkeypatch.setattr(token_files, "_AT_ONCE", 5)
    assert [x.tolist() for x in token_files.word_encoder(PATH, 2)()(texts)] == want
