import random

import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from clickscope.llm import token_counts as T

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def whole(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


ODD = ["", " ", "  a  b ", "a\n\nb c", "x <|endoftext|> y", "a<|endoftext|>b", "don't 'tis it 's", "\t a \n b",
       "café 你好 　 \U0001f600 z", "a  b", "w\x1c x \x1c y", "​ a ​", "1 2 33  444",
       "end ", " start", "a  ", "́ x ́", "q" * 3000, None]


def test_counts_equal_the_library_on_whole_texts():
    rng = random.Random(1)
    parts = ["a", " ", "\n", "'s", "42", "é", "<|endoftext|>", "  ", ".", "word", " ", "\x1c"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)]
    assert T.lengths(texts, PATH) == list(map(whole, texts))


def test_long_texts_are_cut_at_safe_places(monkeypatch):
    monkeypatch.setattr(T, "BATCH_CHARS", 50)
    monkeypatch.setattr(T, "MEMO_WORDS", 7)
    text = "The  quick brown\nfox <|endoftext|> jumps  over 12 lazy dogs' tails. " * 40
    assert "".join(T.parts_of(text, 50)) == text and len(list(T.parts_of(text, 50))) > 5
    assert T.lengths([text, text], PATH) == [whole(text)] * 2


def test_sentencepiece_file():
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["hello there  world", "", None, "a " * 500]
    assert T.lengths(texts, path) == [len(sp.encode(t or "")) for t in texts]


def test_frame_keeps_rows_and_columns(spark):
    rows = [Row(doc_id=i, text=t, n_tokens="clash", kept=i) for i, t in enumerate(ODD)] * 2 + [Row(doc_id=None, text="a b", n_tokens="", kept=0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, kept long")
    got = T.token_counts(df, PATH, limit=2).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), whole(r.text))
        assert r.over_limit == (r.n_tokens > 2)
    assert T.token_counts(df.limit(0), PATH).collect() == []
