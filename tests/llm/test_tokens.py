"""Token ids, token files and packing against the tokenizers library itself."""

import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from inboxlens.llm.elias_fano import EliasFano, encode
from inboxlens.llm.queries import vocabulary
from inboxlens.llm.token_files import TokenFile, read_tokens, write_file, write_tokens
from inboxlens.llm.tokens import encoder
from inboxlens.llm.vector_packing import best_fit, pack_documents

from .helpers import DOCS, EDGES, TRICKY, corpus, docs_df

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module", params=VOCABULARIES)
def both(request):
    path = vocabulary(request.param)
    tok = Tokenizer.from_file(path)
    return tok, encoder(path)


def plain(tok, text):
    return np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_pieces_give_the_ids_of_the_whole_text(both):
    tok, encode_ = both
    rng = random.Random(3)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "　", "'s", "12", "!", "ß", "中", "́", "İ",
            "Σς", "<|endoftext|>", "<|endoftext", "<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "​", "\x0b", "😀", "Über.", "x,,", "it's", "...", "$$$", "Haus "]
    texts = TRICKY + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, encode_(texts), strict=True):
        assert ids == plain(tok, text), ascii(text)


def test_added_tokens(both):
    tok, encode_ = both
    token = next(t.content for t in tok.get_added_tokens_decoder().values())
    texts = [token, f"hello {token} world", f"{token}{token}", f" {token} \n {token}x", f"a{token[:-1]}", f"hello  {token}",
             token.upper(), f"Ünd {token}é.  ", "", "no token", f"{token} " * 50 + "end"]
    assert encode_(texts) == [plain(tok, t) for t in texts]
    ids = {i for i in tok.get_added_tokens_decoder()}
    assert ids & set(np.frombuffer(encode_([f"hello {token} world"])[0], dtype="<u4").tolist())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    for name in VOCABULARIES:
        tok = Tokenizer.from_file(vocabulary(name))
        assert encoder(vocabulary(name))([text])[0] == plain(tok, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 45), max_size=300), st.integers(0, 2 ** 45))
def test_elias_fano(values, x):
    values = sorted(values)
    e = EliasFano(encode(values, 2 ** 45 + 1))
    assert e.all().tolist() == values
    assert e.get(np.arange(len(values))).tolist() == values
    probes = np.array([x, 0, 2 ** 45, *values[:20]])
    assert e.successor(probes).tolist() == np.searchsorted(values, probes).tolist()
    want = [values.index(p) if p in values else -1 for p in probes.tolist()]
    assert e.find(probes).tolist() == want


@pytest.mark.parametrize("name", VOCABULARIES)
def test_known_words_are_encoded_once(name, monkeypatch):
    """Words that keep coming stay known however many others pass, with marks as without."""
    path, calls = vocabulary(name), []
    tok = Tokenizer.from_file(path)

    class Model:
        def tokenize(self, word):
            calls.append(word)
            return tok.model.tokenize(word)

    class Spy:
        model, encode = Model(), tok.encode

        @staticmethod
        def from_file(path):
            return Spy()

    monkeypatch.setattr("tokenizers.Tokenizer", Spy)
    texts = [f" common Über, common. x{chr(97 + i % 26)}{chr(97 + i // 26)}rare common, Über" for i in range(300)]
    got = encoder(path, cache=40)(texts)
    assert got == [plain(tok, t) for t in texts]
    assert sum("common" in c for c in calls) == 1
    assert len(calls) <= 303


@pytest.mark.parametrize("ids", [[5, 7, 7, 100], [None, -3, 4], [-2 ** 62, 2 ** 62 + 5], [None], []])
def test_token_file_round_trip(tmp_path, ids):
    parts = [struct.pack(f"<{i + 1}I", *range(i + 1)) for i in range(len(ids))]
    write_file(str(tmp_path / "t.bin"), ids, parts, 2)
    f = TokenFile(str(tmp_path / "t.bin"))
    assert f.doc_ids == ids
    for i, part in enumerate(parts):
        (s,), (e,) = f.bounds(i, i + 1)
        assert f.ids(int(s), int(e)).tobytes() == part


def test_token_files_hold_every_document(spark):
    rows = corpus() + [(None, "no number", "s"), (500, None, "s"), (501, "again", "s"), (501, "again", "s")]
    manifest = write_tokens(docs_df(spark, rows, extra=("start", "ids")), vocabulary("word_bpe_49k.json"), 1)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32, tuple(r.ids))
                 for r in read_tokens(spark, manifest, with_ids=True).collect())
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    at = 0
    assert [g[0][1] for g in got] == sorted(r[0] or 0 for r in rows if r[0] is None) + sorted(
        r[0] for r in rows if r[0] is not None)
    want = {}
    for d, t, _ in rows:
        want.setdefault(d, []).append(tuple([*tok.encode(t or "", add_special_tokens=False).ids, 1]))
    for (known, d), start, n, crc, ids in got:
        assert ids in want[d if known else None]
        assert (start, n, crc) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += n


def test_no_documents_no_files(spark):
    empty = spark.createDataFrame([], DOCS)
    assert read_tokens(spark, write_tokens(empty, vocabulary("word_bpe_49k.json"), 1)).count() == 0
    assert pack_documents(empty, vocabulary("byte_bpe_50k.json"), 0).count() == 0


@pytest.mark.parametrize("measure", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(100, 100, 1e9), (100, 3, 1e9), (100, 100, 6000.0)])
def test_best_fit_keeps_every_constraint(measure, limits):
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 70, 900))[::-1]
    bins = best_fit(lengths, *limits, measure=measure)
    for b in range(bins.max() + 1):
        own = lengths[bins == b].astype(float)
        assert len(own) and own.sum() <= limits[0] and len(own) <= limits[1] and (own ** 2).sum() <= limits[2]
    least = max(lengths.sum() / limits[0], len(lengths) / limits[1], (lengths.astype(float) ** 2).sum() / limits[2])
    # two small ones often fit together only if neither is large: allow for that
    assert bins.max() + 1 <= 1.25 * least + 1


def test_an_item_too_large_is_an_error():
    with pytest.raises(ValueError):
        best_fit(np.array([50]), 100, 10, 2000.0)


def test_packing_is_whole_and_dense(spark):
    rows = corpus(n=120) + EDGES
    got = pack_documents(docs_df(spark, rows, extra=("row", "piece")), vocabulary("byte_bpe_50k.json"), 0,
                         capacity=256, group_size=64, with_ids=True).toPandas()
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for _, own in got.groupby("row"):
        own = own.sort_values("piece")
        ids = b"".join(own["ids"])
        doc = own["doc_id"].iloc[0]
        assert ids in [plain(tok, r[1] or "") + b"\0\0\0\0" for r in rows if r[0] == doc or (r[0] is None and doc != doc)]
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
        assert (own["length"].iloc[1:] == 256).all() and 1 <= own["length"].iloc[0] <= 256
        assert [zlib.crc32(x) for x in own["ids"]] == own["ids_crc32"].tolist()
    assert got["row"].nunique() == len(rows)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 256
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist()
    groups = -(-len(got) // 64)
    assert got["sequence_id"].nunique() <= got["length"].sum() / 256 * 1.05 + 2 * groups
