"""Pieces of familiar texts are looked at once."""

import pytest


def test_pieces_of_familiar_texts_are_matched_once(monkeypatch):
    """What a familiar text was cut to is a piece already: it isn't matched again, and ids stay the library's."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from tessera.llm import token_binary

    class Once:
        def __init__(self, pattern):
            self.findall, self.more, self.fullmatch = pattern.findall, 0, lambda piece: self.again(pattern, piece)

        def again(self, pattern, piece):
            self.more += 1
            return pattern.fullmatch(piece)

    once = Once(token_binary._PRETOKEN)
    monkeypatch.setattr(token_binary, "_PRETOKEN", once)
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_binary.PieceEncoder(path)
    texts = ["It's they've I'd we'll 're 'x ''s '", "naïve Straße 12ab½ a1 'b  c\n\n d \t", "ÿï¿¿ ÿ x", "", "  ", "a\x00b !?' s"]
    strange = ["日本 it's 12", "a <|endoftext|> b", "it is", "ok￿ it's", "'s日"]
    for group, asked in ((texts, False), (strange + texts, True), (["quite new's words"], False)):
        once.more = 0
        for text, ids in zip(group, own.encode(group), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert (once.more > 0) == asked
