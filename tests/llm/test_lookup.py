"""Batch lookup of strings, and the encoders that stand on it."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from wordloom.llm import length_packing, lookup, queries, transducer


def lists(*found):
    return pa.array(found, pa.list_(pa.string()))


def test_only_new_distinct_strings_are_learned_and_tables_stay_bounded(monkeypatch):
    seen = []
    t = lookup.Table(lambda new: seen.append(sorted(new)) or [w.upper().encode() for w in new], 3)
    assert t.joined(lists(["a", "b", "a"], [], ["", "b"])) == [b"ABA", b"", b"B"]
    assert t.joined(lists(["b", "c"], ["a"])) == [b"BC", b"A"]
    assert t.joined(lists([], [])) == [b"", b""] and t.joined(lists()) == []
    assert seen == [["", "a", "b"], ["c"]] and len(t.strings) == 4
    assert t.joined(lists(["a"])) == [b"A"] and seen[-1] == ["a"] and len(t.strings) == 1   # over the bound: begun anew
    monkeypatch.setattr(lookup, "MOST_BYTES", 0)
    assert t.joined(lists(["a", "z"])) == [b"AZ"] and seen[-1] == ["a", "z"]


def texts(n, seed):
    rng = random.Random(seed)
    signs = ["'", "'s", "''ll", "it's", "X'RE", "a'b'c", "1'2", "9a", "a9!", "..", "!'t", "ÀÉß", "×", "÷", "日本", "İ", " ", "\x1c", "|", "12", "é'd", "-'-"]
    return [None, "", " ", *("".join(rng.choice([*signs, " ", "\n", "\t", "word", "Zed"]) for _ in range(rng.randrange(1, 30))) for _ in range(n))]


@pytest.mark.parametrize("group", [1, 40, 1 << 22])
def test_packing_ids_equal_the_library_however_texts_are_grouped(group, monkeypatch):
    monkeypatch.setattr(length_packing, "GROUP", group)
    e = length_packing.Encoder(public_tokenizers.path(queries.WORD_FILE))
    given = texts(1500, group)
    want = [e.t.encode(t or "", add_special_tokens=False).ids + [1] for t in given]
    assert [memoryview(x).cast("I").tolist() for x in e.encode(given)] == want


def test_a_word_met_again_in_any_batch_is_not_encoded_again():
    e = length_packing.Encoder(public_tokenizers.path(queries.WORD_FILE))
    seen = []
    learn = e.known.learn
    e.known.learn = lambda new: seen.extend(new) or learn(new)
    e.encode(["one two, it's", "two one"])
    e.encode(["Two it's three"])
    assert sorted(seen) == sorted([",", "it's", "one", "three", "two"])


def test_words_of_the_transducer_are_kept_outside_python_objects():
    t = transducer.Transducer(public_tokenizers.path(queries.PIECE_FILE))
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000)]
    first = [x.tolist() for x in t.encode_all([" ".join(words[k: k + 100]) for k in range(0, 20_000, 100)])]
    assert len(t.words.strings) >= 19_900 and t.words.strings.nbytes + t.words.values.nbytes < 100 * 20_000
    assert len(t.parts) <= transducer.PART_CACHE
    again = [t.encode(" ".join(words[k: k + 100])).tolist() for k in range(0, 20_000, 100)]
    assert first == again
