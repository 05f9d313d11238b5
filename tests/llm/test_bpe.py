"""BPE against the tokenizers library, on given texts, odd characters and long words."""

import hashlib
import json
import random
from pathlib import Path

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from risewatch.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.no_truncation()
    out.no_padding()
    return out


def ids_of(text):
    return [i for piece in bpe.coder(PATH).encode(text) for i in piece]


@pytest.mark.parametrize("source", ["docs", "edge"])
def test_digests(request, library, source):
    frame = request.getfixturevalue(source)
    want = []
    for r in frame.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    digests = bpe.token_digests(frame, PATH)
    got = [tuple(r)[:4] for r in digests.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encoded(frame, PATH).count() == frame.count()
    # the state machine's text on all documents: the normalised words with a space after each
    code = bpe.coder(PATH)
    whole = [(r["doc_id"], hashlib.sha256(b"".join(code.bytes[i] for i in library.encode(r["text"] or "", add_special_tokens=False).ids).decode("utf-8", "replace").encode()).hexdigest()) for r in frame.collect()]
    assert sorted(((r["doc_id"], r["restored_sha256"]) for r in digests.collect()), key=str) == sorted(whole, key=str)


def test_empty(empty):
    assert bpe.token_digests(empty, PATH).count() == 0


def test_odd_texts(library):
    rng = random.Random(4)
    parts = ["a", "B", "th", "ing", "é", "é", "ß", "Σ", "ΑΣ", "İ", "1", "²", "'s", "'", "!", "...", "\x1c", "\x85", " ", "　", " ", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "漢", "😀", "ﬁ", "\x00", "Ⅷ", "ǅ", "‍"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_ascii_texts(library):
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(chr(rng.randrange(128)) for _ in range(rng.randint(0, 60)))
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_words_stream_through_a_window(library):
    """Tokens of words of any length; the window holds a bounded number of bytes whatever the word's length."""
    rng = random.Random(5)
    code = bpe.coder(PATH)
    assert code.lookahead < 1000
    for letters in ("ab", "the", "aeiou", "abcdefghijklmnopqrstuvwxyz", "ha", "!.", "éè"):
        text = "".join(rng.choice(letters) for _ in range(7000))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == want
        data = text.encode()
        for step in (1, 7, 1000):
            assert [i for part in code.word_ids(data[k : k + step] for k in range(0, len(data), step)) for i in part] == want


def test_pieces_of_a_long_text(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    text = "Some words, and é more <|endoftext|> of them\nwith 'll and 's. " * 40
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_decode_is_incremental_and_restores_words():
    code = bpe.coder(PATH)
    text = "naïve 漢字 straße 😀 it's 42 times"
    ids = ids_of(text)
    whole = "".join(code.decode([ids]))
    assert "".join(code.decode([[i] for i in ids])) == whole
    assert whole.replace(" ", "") == text.replace(" ", "")
    inner = code.inner  # half a character, then none of the rest
    assert "".join(code.decode([[inner[0xE6]], [inner[0xBC]]])) == "�"


def test_a_file_with_a_decoder_is_refused(tmp_path):
    spec = json.loads(Path(PATH).read_text())
    assert spec.get("decoder") is None
    (tmp_path / "v.json").write_text(json.dumps(spec | {"decoder": {"type": "ByteLevel"}}))
    with pytest.raises(ValueError, match="decoder"):
        bpe.Coder(str(tmp_path / "v.json"))


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError)):
        bpe.Coder(public_tokenizers.path("byte_bpe_50k.json"))
