import pytest

from crateloom.plans.graph_queries import QUERIES
from tests import tables


def test_resolution_scores(spark, tmp_path):
    cases = {  # title, track's title, years, score, decision; the artists are equal
        "same": ("Song", "Song", "1999", "1999", 1.0, "matched"),
        "year": ("Song", "Song", "1999", "2000", 0.62 + 0.28 + 0.05 - 0.15, "review"),
        "no year": ("Song", "Song", None, "2000", 0.62 + 0.28, "review"),
        "versions": ("Long Old Song feat. Ana (Live)", "Long Old Song feat. Ana (Remix)", "1999", "1999", 0.62 * 0.55 + 0.28 + 0.10 - 0.15, "unmatched"),
        "only track": ("Song", "Song feat. Ana (Live)", None, None, 0.62 * 0.82 + 0.28 - 0.12, "unmatched"),
        "title years": ("Song 1999", "Song 1998", None, None, 0.62 * 8 / 9 + 0.28, "review"),
        "other title": ("Abcd", "Wxyz", "1999", "1999", 0.38, "unmatched"),
    }
    rows = [dict(recording_id=k, whosampled_title=a, spotify_title=b, whosampled_release_year=ya, spotify_album_release_date=yb, spotify_track_id=k,
                 whosampled_artist_names="Ana Sol", spotify_artist_names="Ana Sol") for k, (a, b, ya, yb, _, _) in cases.items()]
    got = {r.recording_id: r for r in QUERIES["resolution_scores"](spark, tables.write(tmp_path / "t", {"artist_catalog_recordings_parsed": rows})).collect()}
    for k, (*_, score, decision) in cases.items():
        assert (k, got[k].decision) == (k, decision) and got[k].score == pytest.approx(score, abs=1e-5), k
