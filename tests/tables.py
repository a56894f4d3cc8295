"""Small input tables in the schemas of the data description: filled, empty, all null, with clashing extra columns."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

S, I32, I64, TS, D = pa.string(), pa.int32(), pa.int64(), pa.timestamp("us"), pa.float64()


def _of(text: str, **special) -> pa.Schema:
    return pa.schema([(n, special.get(n, S)) for n in text.split()] + [("collected_at", TS), ("loaded_at", TS)])


_SPOTIFY = " ".join(f"spotify_{x}" for x in "track_id uri url isrc album_name album_id album_release_date album_release_precision album_image_url album_label duration_ms".split())
_WS = " ".join(f"whosampled_{x}" for x in "match_status url title artist_names album label release_year duration genre keywords thumbnail_url thumbnail_path thumbnail_status".split())
SCHEMAS = {
    "spotify_tracks": _of("entry_id playlist_id playlist_url spotify_track_id spotify_uri spotify_url isrc title artist_names artist_ids artists_json album_name album_id album_release_date album_release_precision album_image_url album_label duration_ms", entry_id=I64, duration_ms=I32),
    "recordings": _of(f"row_id recording_id title artist_names album label release_year duration genre keywords {_SPOTIFY} {_WS} youtube_video_id youtube_url youtube_thumbnail_url musicbrainz_recording_id musicbrainz_release_id musicbrainz_country musicbrainz_label", row_id=I64, spotify_duration_ms=I64),
    "artists": _of("artist_id canonical_name spotify_artist_id spotify_uri spotify_url whosampled_name whosampled_url wikidata_qid musicbrainz_artist_id"),
    "credits": _of("credit_id recording_id artist_id artist_name role source_role artist_order source source_url", artist_order=I32),
    "relationships": _of("relationship_id source_recording_id target_recording_id relationship_type related_track related_artist year whosampled_relationship_url detail"),
    "artist_catalog_recordings_parsed": _of("recording_id identity_status " + " ".join(f"whosampled_{x}" for x in "url title artist_names producers album label release_year duration duration_iso duration_ms genre keywords thumbnail_url".split()) + " youtube_video_id youtube_url youtube_thumbnail_url catalog_roles_json catalog_artist_names_json catalog_artist_review_keys_json catalog_provenance_json catalog_track_archive_path spotify_match_status spotify_review_decision canonical_merge_status canonical_recording_id catalog_reconciliation_status catalog_reconciled_at spotify_match_method spotify_match_score spotify_match_margin spotify_track_id spotify_title spotify_artist_names spotify_album_name spotify_album_release_date spotify_duration_ms"),
    "deleted_recordings": pa.schema([("recording_id", S), ("deleted_at", TS)]),
    "documents": _of("doc_id text lang source n_chars artist_id doc_kind", doc_id=I64, n_chars=I64),
    "languages": pa.schema([("lang", S), ("lang_name", S)]),
    "mix_targets": pa.schema([("mix_name", S), ("source", S), ("target_share", D), ("max_repeats", I32)]),
    "pack_capacities": pa.schema([("capacity_name", S), ("capacity_tokens", I32)]),
}
CLASHES = ["node", "root", "key", "value", "text", "packed", "text_id", "group_key", "kind", "n_tokens", "h", "position", "ref_id", "first_loaded", "form", "raw", "theta", "p", "name", "weight", "point", "u", "v", "_k", "_n", "source", "n_real", "trust", "label"]
FIXED = {
    "languages": [dict(lang="en", lang_name="English"), dict(lang="de", lang_name="German")],
    "mix_targets": [dict(mix_name="m", source="a", target_share=0.5, max_repeats=2), dict(mix_name="m", source="b", target_share=0.5, max_repeats=3)],
    "pack_capacities": [dict(capacity_name="small", capacity_tokens=8), dict(capacity_name="large", capacity_tokens=50)],
}


def day(n: int) -> dt.datetime:
    return dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def write(root, rows: dict[str, list[dict]], clash: bool = False) -> str:
    """Write all tables; those not named are empty. ``clash`` adds columns of names that operators use inside."""
    Path(root).mkdir(parents=True, exist_ok=True)
    for name, schema in SCHEMAS.items():
        data = rows.get(name, FIXED.get(name, []))
        if clash:
            for extra in CLASHES:
                if extra not in schema.names:
                    schema = schema.append(pa.field(extra, S))
        table = pa.Table.from_pylist([{f: r.get(f) for f in schema.names} for r in data], schema=schema)
        pq.write_table(table, f"{root}/{name}.parquet")
    return str(root)


def awkward() -> dict[str, list[dict]]:
    """Nulls in every column, blanks, ties, repeated rows and a very long text in every table."""
    out = {}
    for name, schema in SCHEMAS.items():
        if name in FIXED:
            continue
        ident = {"entry_id", "row_id", "doc_id"} & set(schema.names)
        rows = []
        for k, text in enumerate([None, "", " ", "x", "x", 'a "b, c; d', "A & B, C" * 3000, "​", "REC_1"]):
            row = {f.name: text if f.type == S else day(k % 2) if f.type == TS else 5 for f in schema}
            if text is None:
                row = dict.fromkeys(row)
            rows.append(row | {i: k for i in ident})
        out[name] = rows + ([] if ident else rows[3:5])
    return out
