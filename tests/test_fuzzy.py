from hypothesis import given
from hypothesis import strategies as st

from accordant.functions.fuzzy import lcs, ratio, token_set_ratio, token_sort_ratio

words = st.lists(st.sampled_from(["alpha", "beta", "inc", "co", "a", "gamma"]), max_size=5).map(" ".join)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text("abcd", max_size=20), st.text("abcd", max_size=20))
def test_lcs_is_the_table(a, b):
    assert lcs(a, b) == plain_lcs(a, b)


@given(words, words)
def test_ratios_are_symmetric_and_bounded(a, b):
    for f in (token_sort_ratio, token_set_ratio):
        assert 0 <= f(a, b) <= 100 and f(a, b) == f(b, a)


def test_known_values():
    assert round(token_sort_ratio("alpha widgets", "alpha widget"), 2) == 96.0
    assert round(token_set_ratio("alpha widgets", "alpha widget"), 2) == 96.0
    assert round(token_sort_ratio("company inc", "company llc"), 2) == 81.82
    assert token_sort_ratio("", "") == 100 and token_set_ratio("", "") == 0
    assert token_set_ratio("hotel resort", "hotel resort spa") == 100
    assert ratio("kitten", "sitting") == 100 * 8 / 13
