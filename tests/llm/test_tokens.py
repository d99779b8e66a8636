import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import _tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(PATH)


def ids(tool, text):
    return tool.encode(text or "", add_special_tokens=False).ids


def columns(mine, texts, end_id=2):
    out = []
    for got, bounds in mine.encode_column(pa.array(texts, pa.string()), end_id):
        assert bounds[0] == 0 and bounds[-1] == len(got)
        out += [got[b:e].tolist() for b, e in zip(bounds[:-1], bounds[1:])]
    return out


def test_words_are_encoded_once_whatever_marks_follow(tool, monkeypatch):
    mine, text = _tokens.UnitEncoder(PATH), "stoneth, stoneth. stoneth!?; stoneth### stoneth\nstoneth:"
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids(tool, text)
    assert set(mine._young) == {"\nstoneth", "stoneth"}
    monkeypatch.setattr(mine, "_words", lambda words: [] if not words else pytest.fail(f"{words} again"))
    assert np.frombuffer(mine.encode("stoneth; stoneth"), "<u4").tolist() == ids(tool, "stoneth; stoneth")


def test_units_of_a_column_are_looked_up_once(tool, monkeypatch):
    mine, asked = _tokens.UnitEncoder(PATH), []
    look_up = mine._look_up
    monkeypatch.setattr(mine, "_look_up", lambda units: asked.extend(units) or look_up(units))
    assert columns(mine, ["one two one two", "\none two", None, "two one"] * 50) == [[*ids(tool, t), 2] for t in ["one two one two", "\none two", None, "two one"] * 50]
    assert len(asked) == len(set(asked)) == 5


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_columns_in_slices_equal_whole_texts(tool, odd_texts, monkeypatch, size):
    monkeypatch.setattr(_tokens, "SLICE_BYTES", size)
    texts = [*odd_texts, "it's, don't. we'll!", "x', y'. 'quoted,'", "a) b), (c. d... e,,,,, 7. 8½, .", ",", " ,", "end,\n,start\n.", "été. ÷. ×, ª. º! naïve? Ωmega, слово. ѣ҂."]
    assert columns(_tokens.UnitEncoder(PATH), texts) == [[*ids(tool, t), 2] for t in texts]
    assert columns(_tokens.UnitEncoder(PATH), []) == []


def test_every_letter_and_mark(tool):
    mine = _tokens.UnitEncoder(PATH)
    assert len(mine._letters) > 300 and all(c.isalpha() for c in mine._letters)
    texts = [f"{c}{m} x{c}{m}\n{c}{c.upper()}{m}{m}" for c in sorted(mine._letters) for m in _tokens._MARKS]
    assert columns(mine, texts) == [[*ids(tool, t), 2] for t in texts]


def test_added_tokens_within_words(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.add_tokens(["stone", "th,"])
    other.save(str(tmp_path / "t.json"))
    mine, text = _tokens.UnitEncoder(str(tmp_path / "t.json")), "a stoneth, athth, b"
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids(other, text)


def test_small_batches_are_put_together(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"i": [k], "t": ["x" * 10]}) for k in range(10)]
    monkeypatch.setattr(_tokens, "SLICE_BYTES", 4 * batches[0].nbytes)
    assert [b.column(0).to_pylist() for b in _tokens.grouped(iter(batches))] == [[0, 1], [2, 3], [4, 5], [6, 7], [8, 9]]
    assert list(_tokens.grouped(iter([]))) == []
