"""Every query of the core against its SQL, and over empty and odd tables."""

import pytest

from strophe.plans import registry
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, small, name):
    assert_same(spark, small, registry.queries()[name], registry.oracle_sql()[name])


@pytest.mark.parametrize("kind", ["empty", "odd"])
@pytest.mark.parametrize("name", [n for n in sorted(registry.queries()) if n[0] == "p" and n[1].isdigit()])
def test_odd_tables(spark, odd_tables, name, kind):
    rows = registry.queries()[name](spark, odd_tables[kind]).collect()
    assert kind == "odd" or not rows


#: Queries that work on songs in blocks; each must be right, too, where one song has most rows.
BLOCKED = ("greedy_merge_a", "merge_b_totals", "duration_batches", "asr_packs", "pack_960", "fixed_batches", "speaker_batches", "service_tasks", "speaker_turn_merge", "ill_flag", "segment_rate", "overlap_label", "speaker_runs", "gap_fill", "boundary_adjust", "viewer_rows", "p3_found", "p3_periods", "gaps_stream", "turn_stats")


@pytest.fixture(scope="module")
def hot_tables(small, tmp_path_factory):
    """The small tables with two thirds of the songs put into one, one after the other in time."""
    import duckdb

    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in ("segments", "songs", "structures", "vad", "embeddings"):
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM '{small}/{name}.parquet'")
    con.execute("CREATE TABLE place AS SELECT song_id, row_number() OVER (ORDER BY song_id) AS n FROM (SELECT DISTINCT song_id FROM segments WHERE song_id IS NOT NULL) WHERE hash(song_id) % 3 > 0")
    for name, number in (("segments", "seg_no"), ("vad", "seg_no"), ("structures", "st_no")):
        con.execute(f"""UPDATE {name} SET "start" = "start" + 4000 * n, "end" = "end" + 4000 * n, {number} = {number} + 5000 * n, song_id = 'hot' FROM place WHERE place.song_id = {name}.song_id""")
    con.execute("UPDATE songs SET song_id = 'hot' WHERE song_id IN (SELECT min(song_id) FROM place)")
    for name in ("segments", "songs", "structures", "vad", "embeddings"):
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", BLOCKED)
def test_hot_songs(spark, hot_tables, name):
    assert_same(spark, hot_tables, registry.queries()[name], registry.oracle_sql()[name])
