import time

from hypothesis import given, settings, strategies as st

from tidemark.llm import pii
from tidemark.llm.spans import first_apart, touching

some = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)).map(lambda p: (p[0], p[0] + p[1])), max_size=15)


@settings(max_examples=400, deadline=None)
@given(some, some)
def test_touching_and_first_apart_by_force(spans, asked):
    touches = touching(spans)
    assert [touches(a, b) for a, b in asked] == [any(s < b and a < e for s, e in spans) for a, b in asked]
    kept = []
    for a, b in asked:
        if not any(s < b and a < e for s, e in kept):
            kept.append((a, b))
    assert first_apart(asked) == kept


class Anything:
    trees, threshold = [1], 0.5

    def probability(self, rows):
        return rows[:, 0] * 0 + 0.9


def test_long_lists_take_time_in_proportion():
    models = dict.fromkeys(pii.KINDS, Anything())
    spent = []
    for many in (2_000, 16_000):
        text = "\n".join(f"user{i} at host{i}.example.org, user{i}@host{i}.example.org" for i in range(many))
        at = time.process_time()
        ((base, found),) = pii.find_in_texts([text], models)
        spent.append(time.process_time() - at)
        assert len(base) == many and len(found) == 2 * many
    assert spent[1] < 24 * spent[0]
