import pyarrow as pa
from hypothesis import given, settings, strategies as st

from depotflow.llm.words import sequences, slices, whole_runs
from tests.llm.helpers import words

text = st.text(alphabet="ab é\t\n\x0b \U0001f600", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), text), max_size=8), st.integers(1, 40))
def test_words_of_slices_are_those_of_the_pattern(texts, size):
    found, hashes = [], {}
    for part in slices(pa.chunked_array([pa.array(texts, pa.string())]), size=size):
        own = part.hashes()
        for row in range(part.rows):
            a, b = part.words[row], part.words[row + 1]
            got = [part.data[s:e].tobytes().decode() for s, e in zip(part.starts[a:b], part.ends[a:b])]
            found.append(got)
            for word, value in zip(got, own[a:b]):
                assert hashes.setdefault(word, value) == value
    assert found == [words(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=40, deadline=None)
@given(st.lists(text, min_size=1, max_size=6), st.integers(1, 4))
def test_sequences_are_equal_where_the_words_are(texts, length):
    seen = {}
    for part in slices(pa.array(texts)):
        flat = [w for t in texts for w in words(t)]
        inside = whole_runs(part, length)
        bounds = part.words
        for place, (value, whole) in enumerate(zip(sequences(part.hashes(), length), inside)):
            run = tuple(flat[place:place + length])
            assert seen.setdefault(run, value) == value
            assert whole == any(bounds[r] <= place and place + length <= bounds[r + 1] for r in range(part.rows))
    assert len(set(seen.values())) == len(seen)


def test_a_sliced_column_and_a_long_text():
    column = pa.array(["skip", "a b", None, "c " * 100_000])[1:]
    counts = [n for part in slices(column, size=1000) for n in part.counts]
    assert counts == [2, 0, 100_000]
