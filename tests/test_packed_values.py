import random
from itertools import chain, combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crateloom.operators.packed_values import _Field, _modes, cheapest, spans
from crateloom.plans import packed_queries as Q
from tests import tables

KNOWN = {n: 8.0 for n in ["Ann Lee", "Bob Ray", "Cy, Di & Eve", "Fox and the Owls", '"Little" Gus', "Hal/Ivy", "Jo"]}
CASES = {
    "Ann Lee, Bob Ray": ["Ann Lee", "Bob Ray"], "Ann Lee; ; Bob Ray ;": ["Ann Lee", "Bob Ray"],
    "Cy, Di & Eve, Bob Ray": ["Cy, Di & Eve", "Bob Ray"], '"Cy, Di & Eve" | Ann Lee': ["Cy, Di & Eve", "Ann Lee"],
    "Ann Lee (feat. Bob Ray, Jo)": ["Ann Lee", "Bob Ray", "Jo"], "Fox and the Owls": ["Fox and the Owls"],
    "Fox and the Owls and Jo": ["Fox and the Owls", "Jo"], '"""Little"" Gus", Jo': ['"Little" Gus', "Jo"],
    '["\\"Little\\" Gus", "Jo"]': ['"Little" Gus', "Jo"], "Hal/Ivy / Jo": ["Hal/Ivy", "Jo"],
    "Zed Unknown, Yan Unheard": ["Zed Unknown", "Yan Unheard"], "Ann Lee": ["Ann Lee"], "": [], " ; ": [], '"': ['"'], "[broken": ["[broken"],
}


@pytest.mark.parametrize("text", CASES)
def test_cheapest_dialect(text):
    assert cheapest(text, KNOWN, 3, 12.0) == CASES[text]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(list(KNOWN)), min_size=1, max_size=5, unique=True), st.sampled_from([", ", "; ", " | ", " / ", ";;"]))
def test_round_trip(names, sep):
    packed = sep.join('"' + n.replace('"', '""') + '"' for n in names)
    assert cheapest(packed, KNOWN, 3, 12.0) == names
    assert set(names) <= spans(packed, 3)


def test_branch_and_bound_is_exact():
    """Against all sets of delimiters, with up to all twelve kinds in one field."""
    rnd = random.Random(8)
    seps = [", ", "; ", " | ", "/", " feat. ", " vs ", " & ", " + ", " · ", " x ", " with ", " and "]
    names = [*KNOWN, "Zed", "Q", "Yan Unheard", "", '"Al"']
    for n in [1, 2, 3, 5, 8, 12, 14] * 6:
        text = rnd.choice(names) + "".join(rnd.choice(seps) + rnd.choice(names) for _ in range(n))
        best = []
        for quoted in _modes(text):
            field = _Field(text, quoted, KNOWN, 12.0, 3)
            kinds = sorted(set(field.classes))
            for chosen in chain.from_iterable(combinations(kinds, k) for k in range(len(kinds) + 1)):
                cost, values = field.parse(frozenset(chosen))
                best.append((cost, len(values), values))
        assert cheapest(text, KNOWN, 3, 12.0) == min(best)[2], text


def test_json_is_priced_like_other_dialects():
    assert cheapest('["Ann Lee", "Bob Ray"]', KNOWN, 3, 12.0) == ["Ann Lee", "Bob Ray"]
    assert cheapest('["Ann Lee"]', {**KNOWN, '["Ann Lee"]': 1.0}, 3, 12.0) == ['["Ann Lee"]']


def test_a_corrupt_known_name_adds_no_spans_elsewhere():
    from crateloom.operators.packed_values import FILTER_BITS, _slot

    starts = bytearray(FILTER_BITS)
    starts[_slot("X", 50)] = 1
    assert spans("Ann, Bob, Cy", [50], starts) == {"Ann", "Bob", "Cy"}
    assert spans("X" + ", Y" * 50, [50], starts) == {"X", "Y", "X" + ", Y" * 50}


def test_long_field():
    assert cheapest("Ann Lee, " * 2000, KNOWN, 3, 12.0) == ["Ann Lee"] * 2000


def test_found(spark, tmp_path):
    rows = {
        "artists": [dict(artist_id=str(k), canonical_name=n) for k, n in enumerate(KNOWN)],
        "spotify_tracks": [dict(entry_id=1, artist_names="Cy, Di & Eve, Jo"), dict(entry_id=2, artist_names="Cy, Di & Eve"), dict(entry_id=3)],
        "artist_catalog_recordings_parsed": [dict(recording_id="R", whosampled_artist_names="Ann Lee; Bob Ray")] * 2,
    }
    got = Q.p2_found(spark, tables.write(tmp_path / "t", rows)).collect()
    assert sorted(map(tuple, got)) == [
        ("artist_catalog_recordings_parsed", "R", 1, "Ann Lee"), ("artist_catalog_recordings_parsed", "R", 2, "Bob Ray"),
        ("spotify_tracks", "1", 1, "Cy, Di & Eve"), ("spotify_tracks", "1", 2, "Jo"),
    ]


@pytest.mark.parametrize("kind", ["empty", "awkward"])
def test_awkward_tables(spark, inputs, kind):
    for q in Q.QUERIES.values():
        rows = q(spark, inputs[kind]).collect()
        assert kind == "awkward" or rows == []
