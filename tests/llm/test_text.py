import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from mirrorsmith.llm import text
from tests.llm.util import WORD, odd_texts

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\rabAB.é日\U0001F600\x1c ", max_size=40)), max_size=8)


def words_of(texts, kind):
    out = []
    for _, _, buf, off in text.chunks(pa.array(texts, kind)):
        s, e, row = text.word_ranges(buf, off)
        h = text.hash_ranges(buf, s, e, text.byte_values(1, False))
        raw = buf.tobytes()
        out += [[(raw[s[i]:e[i]].decode(), int(h[i])) for i in range(row[k], row[k + 1])] for k in range(len(off) - 1)]
    return out


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    for kind in (pa.string(), pa.large_string()):
        got = words_of(texts, kind)
        assert [[w for w, _ in r] for r in got] == [WORD.findall(t or "") for t in texts]
        by_word = {}
        for r in got:
            for w, h in r:
                assert by_word.setdefault(w, h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = odd_texts()
    want = words_of(texts, pa.string())
    monkeypatch.setattr(text, "CHUNK", 50)
    assert words_of(texts, pa.string()) == want
    assert words_of(texts[3:], pa.string()) == want[3:]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingle_sets_have_the_sizes_of_plain_sets(texts, k):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    got = list(text.shingle_sets(pa.array(texts, pa.string()), k))
    want = []
    for t in texts:
        w = WORD.findall(low(t or ""))
        want.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_structured_texts_have_different_hashes():
    """Two letters in the Thue-Morse order and swapped, at every length and seed; ranges over and under the lanes."""
    bits = [bin(i).count("1") & 1 for i in range(1 << 13)]
    for n in (1, 2, 8, 16, 32, 33, 64, 1024, 8192):
        one, two = (bytes(b"ab"[x ^ s] for x in bits[:n]) for s in (0, 1))
        buf = np.frombuffer(one + two, np.uint8)
        for seed in (1, 21, 22, 41):
            a, b = text.hash_ranges(buf, np.array([0, n]), np.array([n, 2 * n]), text.byte_values(seed, True))
            assert a != b


def test_zero_bytes_count():
    buf = np.zeros(200, np.uint8)
    starts = np.zeros(100, np.int64)
    h = text.hash_ranges(buf, starts, np.arange(100), text.byte_values(1, False))
    assert len(set(h.tolist())) == 100
