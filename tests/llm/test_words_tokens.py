import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cueforge.llm import tokens, words

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


@pytest.mark.parametrize("chunk", [64, 1 << 21])
def test_word_hashes(monkeypatch, chunk):
    monkeypatch.setattr(words, "CHUNK", chunk)
    random.seed(1)
    texts = ["".join(random.choice("aB \n\tcé ") for _ in range(random.choice([0, 1, 3, 10, 40]))) for _ in range(300)] + [None, "", "x" * 500]
    h, at = words.word_hashes(pa.array(texts))
    expected = [plain_words(t) for t in texts]
    assert [len(x) for x in expected] == np.diff(at).tolist()
    seen = {}
    for w, x in zip([w for ws in expected for w in ws], h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    runs, to = words.shingles(h, at, 5)
    expected = [[tuple(ws[i : i + 5]) for i in range(len(ws) - 4)] if len(ws) >= 5 else [tuple(ws)] if ws else [] for ws in expected]
    assert [len(x) for x in expected] == np.diff(to).tolist()
    seen = {}
    for w, x in zip([w for ws in expected for w in ws], runs.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_token_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    random.seed(5)
    texts = ["Hello, World's it's <|endoftext|>x <|startoftext|> a<|startoftext|>b ́e é  x　y ΑΣ Σ İ \x1c a\x85b 12 345!!", None, "", "  ", "don't\x0bstop\x0cnow"]
    texts += ["".join(random.choice("aB é.'!-,1½İ́ sT\n|<>") for _ in range(30)) for _ in range(500)]
    for part in (texts, [t.replace("<|", "<") if t else t for t in texts]):
        assert [x.tolist() for x in tokens.encode(pa.array(part), PATH)] == [tok.encode(t or "", add_special_tokens=False).ids for t in part]
