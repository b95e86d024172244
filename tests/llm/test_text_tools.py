"""Words by bytes, token ids, decoding and automata, without Spark."""

import io
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainloom.llm import licenses, media, packing, sharding, warc
from grainloom.llm.textbytes import SOLID, WORD, slices, word_hashes, words
from grainloom.llm.wordbpe import WordBpe, default_path

ODD = ["", None, "  a b", "It's DON'T x's", "İstanbul ΣΑΣ ß ﬁ", "á éx", "<|endoftext|> hi", "12ab34 ... ??!a", "日本語 한국어", "a\x1cb\x85c\x0bd", "'s 's", "--- a--b Ⅷ ª º µ", "ÀÉÞß÷×ÿ x÷y ÉA1É", "\xa0x\xa0", "a", ""]
any_text = st.lists(st.one_of(st.none(), st.text(max_size=40), st.sampled_from(ODD)), max_size=12)


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(default_path())


@settings(deadline=None, max_examples=60)
@given(any_text)
def test_ids_are_the_librarys(texts):
    bpe = test_ids_are_the_librarys.bpe
    want = [e.ids for e in bpe.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [ids[b[i] : b[i + 1]].tolist() for first, last, ids, b in bpe.encode(pa.array(texts, pa.string())) for i in range(last - first)]
    assert got == want


test_ids_are_the_librarys.bpe = WordBpe(default_path())


def test_written_added_tokens_are_those_of_a_plain_call():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_path())
    texts = ["a <|endoftext|> b", "x<|startoftext|>y1<|endoftext|>", "<|ENDOFTEXT|> a<|b |> <| <", "<|endof text|>", "it's<|endoftext|>É", "<|endoftext|><|endoftext|>\n<", "|", "a<"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    got = [ids[b[i] : b[i + 1]].tolist() for first, last, ids, b in WordBpe(default_path()).encode(pa.array(texts)) for i in range(last - first)]
    assert got == want and want[0] == [320, 49407, 321]


@settings(deadline=None)
@given(any_text)
def test_words_are_those_of_the_patterns(texts):
    for kind, pattern in ((WORD, rb"[0-9A-Za-z\x80-\xff]+"), (SOLID, rb"[^\x20\x09-\x0D]+")):
        got = []
        for s in slices(pa.array(texts, pa.string()), most=8):
            starts, ends, per = words(s, kind)
            got += [[s.data[a:b].tobytes() for a, b in zip(starts[per[i] : per[i + 1]], ends[per[i] : per[i + 1]])] for i in range(s.last - s.first)]
        assert got == [re.findall(pattern, (t or "").encode()) for t in texts]


def test_equal_words_hash_alike_and_others_do_not():
    data = np.frombuffer(b"ab ba ab a b aab aba", np.uint8)
    starts, ends, _ = words(next(slices(pa.array([data.tobytes().decode()]))), SOLID)
    h = word_hashes(data, starts, ends)
    assert h[0] == h[2] and len(set(h.tolist())) == 6


def _used(plan):
    out = {}
    for times, lengths in plan.patterns:
        assert times > 0 and sum(lengths) <= plan.room
        for x in lengths:
            out[x] = out.get(x, 0) + times
    return out


def _bins(items, room, best=None, bins=()):
    """The least number of bins by trying everything."""
    best = len(items) if best is None else best
    if len(bins) >= best:
        return best
    if not items:
        return len(bins)
    x, *rest = items
    for i in range(len(bins)):
        if bins[i] >= x and bins[i] not in bins[:i]:
            best = min(best, _bins(rest, room, best, (*bins[:i], bins[i] - x, *bins[i + 1 :])))
    return min(best, _bins(rest, room, best, (*bins, room - x)))


@settings(deadline=None, max_examples=150)
@given(st.integers(4, 24).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), max_size=9))))
def test_reduction_never_costs_a_sequence(case):
    room, items = case
    counts = np.bincount(items, minlength=room + 1)
    plan = packing.solve(counts, room)
    assert _used(plan) == {x: n for x, n in enumerate(counts.tolist()) if n}
    left = counts.copy()
    fixed = sum(n for n, _ in packing.reduce_instance(left, room))
    rest = sorted((x for x, n in enumerate(left) for _ in range(n)), reverse=True)
    assert fixed + _bins(rest, room) == _bins(sorted(items, reverse=True), room)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_by_counts_is_best_fit_by_pieces(items):
    rest = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rest if r >= x]
        if fits:
            rest.remove(min(fits))
            rest.append(min(fits) - x)
        else:
            rest.append(30 - x)
    assert sum(n for n, _ in packing.best_fit(np.bincount(items, minlength=31), 30)) == len(rest)


def test_places_cover_every_rank_once():
    counts = np.bincount(np.random.default_rng(3).integers(1, 65, 4000), minlength=65)
    plan = packing.solve(counts, 64)
    at = packing.places(plan)
    for length in range(1, 65):
        own = at["length"] == length
        assert (at["rank"][own][:1] == 0).all() and (np.diff(at["rank"][own]) > 0).all()
    assert plan.sequences - plan.bound <= 2


@given(st.lists(st.tuples(st.text(min_size=1, max_size=4), st.integers(0, 1000)), max_size=40, unique_by=lambda x: x[0]))
def test_longest_first_balances(units):
    placed = sharding.longest_first(units, 4)
    loads = [0] * 4
    for u, n in units:
        loads[placed[u]] += n
    assert len(placed) == len(units) and max(loads) - min(loads) <= max([n for _, n in units], default=0)


def _area(samples, high, wide):
    """Each cell's mean with every sample cut in parts."""
    rows, columns = samples.shape
    fine = np.repeat(np.repeat(samples, high, 0), wide, 1)
    return fine.reshape(high, rows, wide, columns).mean((1, 3))


@pytest.mark.parametrize("shape", [(1, 1), (1, 64), (3, 64), (7, 5), (64, 64), (9000, 3)])
def test_area_resize_is_exact(shape):
    samples = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    assert np.allclose(media.area_resize(samples, 8, 9), _area(samples, 8, 9), atol=1e-6)


def test_pictures_round_trip():
    rng = np.random.default_rng(2)
    for shape in ((1, 1), (3, 5), (7, 64), (2, 3)):
        samples = rng.integers(0, 256, shape).astype(np.uint8)
        for encode in (media.encode_pgm, media.encode_bmp):
            assert (media.decode(encode(samples)) == samples).all()
    assert media.decode(b"P1\n# note\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 1, 0], [1, 0, 1]]
    assert media.decode(b"P2 2 1 255 7 9").tolist() == [[7, 9]]
    assert media.decode(b"P3 1 1 255 7 9 11").tolist() == [[[7, 9, 11]]]
    assert media.decode(b"P4\n3 2\n\xa0\x40").tolist() == [[0, 1, 0], [1, 0, 1]]
    assert media.decode(b"P6 1 1 255\n\x07\x09\x0b").tolist() == [[[7, 9, 11]]]
    assert media.decode(b"P5 1 1 65535\n\x01\x02").tolist() == [[258]]
    with pytest.raises(ValueError):
        media.decode(b"GIF89a")
    with pytest.raises(ValueError):
        media.decode(b"P5 9")


def test_padding_and_tiles():
    assert [len(media.pad(bytes(n))) for n in (0, 1, 63, 64, 65, 128)] == [64, 64, 64, 64, 128, 128]
    small = np.arange(72, dtype=np.uint8).reshape(8, 9)
    assert (np.load(io.BytesIO(media.npy(small))) == small).all() and media.difference_hash(small) == "f" * 16


def test_templates_accept_their_markup_and_nothing_else():
    a = licenses.compile_template('one <<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> four <<var;name="v";original="x";match="[a-z]+( [a-z]+)?">> five')
    yes = ("one four x five", "one two four x y five", "one two three four x five")
    no = ("one three four x five", "one four five", "one four x y z five", "one two four", "four x five")
    for text, want in [(t, True) for t in yes] + [(t, False) for t in no]:
        spoken = licenses.spoken(text.encode())
        assert (a.longest(spoken, 0) == len(spoken.tokens)) is want, text
    assert licenses.anchor('<<beginOptional>>a b c d<<endOptional>> x y <<var;name="v";original="";match=".{0,9}">> z')[0] == (b"x", b"y")
    for bad in ("a <<endOptional>>", "<<beginOptional>> a"):
        with pytest.raises(ValueError):
            licenses.compile_template(bad)


def test_bundles_round_trip_and_seek():
    rng = random.Random(4)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randrange(3000))) for _ in range(400)]
    bundle = warc.Bundle()
    for i, p in enumerate(payloads):
        bundle.add(str(i), warc.record(str(i), "http://a/b", p, "d", None, len(p)))
    data = bundle.close()
    frames = warc.read_seek_table(data)
    assert len(frames) > 1 and sum(f[1] for f in frames) == sum(len(x) for x in bundle.parts)
    got = [p for k in range(len(frames)) for _, _, p in warc.parse(warc.frame_of(data, k))]
    assert got == payloads
    for page_id, frame, offset, _ in rng.sample(bundle.index, 20):
        _, headers, payload = next(warc.parse(warc.frame_of(data, frame), offset))
        assert headers["warc-record-id"] == f"<urn:page:{page_id}>" and payload == payloads[int(page_id)]
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 400
