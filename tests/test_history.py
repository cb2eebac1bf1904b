from datetime import date

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import retail
from stardw.operators import quality, scd
from stardw.plans import dimensions, staging
from stardw.schemas import conform
from stardw.session import local_rows, scratch_dir
from stardw.sources import histories
from stardw.sources.snapshots import Warehouse

DAY1, DAY2, DAY3 = date(2001, 11, 30), date(2001, 12, 31), date(2002, 1, 31)


def load(spark, history, rows, day):
    staged = local_rows(spark, rows, "id bigint, v string, hash_ligne string")
    return scd.scd2_merge(history, staged, "id", "cle", day)


def table(history):
    return sorted((r.id, r.v, r.effectif_du, r.effectif_au, r.est_courant, r.cle)
                  for r in history.collect())


def test_unchanged_changed_new_and_vanished(spark):
    one = load(spark, None, [(1, "a", "a"), (2, "b", "b"), (3, "c", "c")], DAY1)
    two = load(spark, one, [(1, "a", "a"), (2, "B", "B"), (4, "d", "d"), (0, "z", "z")], DAY2)
    assert table(two) == [
        (0, "z", DAY2, None, True, 4), (1, "a", DAY1, None, True, 1),
        (2, "B", DAY2, None, True, 5), (2, "b", DAY1, DAY2, False, 2),
        (3, "c", DAY1, None, True, 3), (4, "d", DAY2, None, True, 6)]


def test_same_batch_again_changes_nothing(spark):
    rows = [(1, "a", "a"), (2, "b", "b")]
    one = load(spark, None, rows, DAY1)
    assert table(load(spark, one, rows, DAY2)) == table(one)


def test_two_changes_in_a_day_leave_an_empty_version(spark):
    one = load(spark, None, [(1, "a", "a")], DAY1)
    three = load(spark, load(spark, one, [(1, "b", "b")], DAY2), [(1, "c", "c")], DAY2)
    assert (1, "b", DAY2, DAY2, False, 2) in table(three)
    assert {r.controle: r.nb_lignes for r in quality.history_faults(
        three, "id", "cle").collect()} == {
            "intervalles_non_contigus": 0, "fins_avant_debut": 0, "courante_pas_derniere": 0,
            "plusieurs_courantes": 0, "cle_en_double": 0}


def test_closed_versions_are_never_compared(spark):
    one = load(spark, None, [(1, "a", "a")], DAY1)
    two = load(spark, one, [(1, "b", "b")], DAY2)
    three = load(spark, two, [(1, "a", "a")], DAY3)
    assert [(v, c) for _, v, _, _, c, _ in table(three)] == [
        ("a", False), ("a", True), ("b", False)]


def test_null_and_empty_group_are_the_same_client(spark):
    rows = retail.base_rows()
    one = dimensions.client_versions(staging.clients(retail.source(spark)), DAY1)
    named = retail.source(spark, groupe_client=[*rows["groupe_client"], (9, "")], client=[
        c if c[0] != 200 else (*c[:5], 9, *c[6:]) for c in rows["client"]])
    two = dimensions.client_versions(staging.clients(named), DAY1)
    hashes = [{r.client_id: r.hash_ligne for r in d.collect()} for d in (one, two)]
    assert hashes[0] == hashes[1]


def test_the_new_year_moves_age_brackets(spark):
    staged = staging.clients(retail.source(spark))
    before = dimensions.client_versions(staged, date(2001, 12, 31))
    after = dimensions.client_versions(staged, date(2002, 1, 1))
    moved = before.join(after, ["client_id", "hash_ligne"], "left_anti").collect()
    assert [r.client_id for r in moved] == [100]  # 24 years, then 25


def test_faults_are_found(spark):
    schema = ("cle bigint, id bigint, effectif_du date, effectif_au date, est_courant boolean")
    history = local_rows(spark, [
        (1, 1, DAY1, DAY2, False), (2, 1, DAY3, None, True),           # gap
        (3, 2, DAY1, None, True), (3, 2, DAY2, None, True),            # two current, one key
        (4, 3, DAY2, DAY1, False)], schema)                            # ends early, none current
    got = {r.controle: r.nb_lignes
           for r in quality.history_faults(history, "id", "cle").collect()}
    assert got == {"intervalles_non_contigus": 2, "fins_avant_debut": 1,
                   "courante_pas_derniere": 2, "plusieurs_courantes": 1, "cle_en_double": 1}


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 6), st.sampled_from("abc"), min_size=1),
                min_size=1, max_size=3))
def test_history_follows_a_plain_model(spark, batches):
    versions, history = {}, None
    for i, batch in enumerate(batches):
        day = date(2001, 1, 1 + i)
        history = load(spark, history, [(k, v, v) for k, v in batch.items()], day)
        for k, v in batch.items():
            past = versions.setdefault(k, [])
            if not past or past[-1][0] != v:
                if past:
                    past[-1] = (past[-1][0], past[-1][1], day, False)
                past.append((v, day, None, True))
    got = {}
    for r in history.collect():
        got.setdefault(r.id, []).append((r.v, r.effectif_du, r.effectif_au, r.est_courant))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        k: sorted(v, key=str) for k, v in versions.items()}
    assert len({r.cle for r in history.collect()}) == history.count()


def stored(spark, rows):
    schema = "client_id bigint, nom_complet string, hash_ligne string"
    staged = local_rows(spark, [(k, v, v) for k, v in rows.items()], schema)
    return staged.select("client_id", "nom_complet", *[
        F.lit(None).cast(t).alias(c) for c, t in [
            ("sexe", "string"), ("tranche_age", "string"), ("groupe_client", "string"),
            ("a_carte_fidelite", "boolean"), ("nom_ville", "string"), ("nom_pays", "string"),
            ("nom_continent", "string")]], "hash_ligne")


def play(spark, store, loads, bits):
    """The history stored by ranges, and the same by one merge a load."""
    entry, whole, days = None, None, []
    for n, rows in enumerate(loads):
        day = date(2001, 1, 1 + n)
        before = entry
        entry, opened = histories.load(store, "dim_client", stored(spark, rows), "client_id", "cle_client", day, entry, bits=bits)
        whole = scd.scd2_merge(whole, stored(spark, rows), "client_id", "cle_client", day)
        days.append((before, entry, opened))
    return entry, whole, days


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(loads=st.lists(st.dictionaries(st.integers(0, 30), st.sampled_from("abc"), min_size=1, max_size=10), min_size=2, max_size=3))
def test_ranges_like_a_whole_merge(spark, loads):
    store = Warehouse(spark, scratch_dir(spark, "h"))
    entry, whole, days = play(spark, store, loads, bits=3)
    columns = ["client_id", "nom_complet", "effectif_du", "effectif_au", "est_courant", "cle_client"]
    assert sorted(map(str, store.open("dim_client", entry).select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
    assert sum(opened for *_, opened in days) == whole.count()


def test_a_load_that_changes_one_client_rewrites_one_range(spark, store):
    rows = {k: "a" for k in range(40)}
    entry, _, days = play(spark, store, [rows, rows, rows | {17: "b"}, {k: v for k, v in rows.items() if k != 3} | {17: "b"}], bits=3)
    (_, first, n), (_, same, none), (_, one, opened), (_, vanished, gone) = days
    assert (n, none, opened, gone) == (40, 0, 1, 0) and same == first
    changed = {p for p in one["parts"] if one["parts"][p] != same["parts"].get(p)}
    assert changed == {"true/tranche=2", "false/tranche=2"}
    # Client 3 has vanished: his range is looked at, and his version stays.
    assert {p for p in vanished["parts"] if vanished["parts"][p] != one["parts"].get(p)} == {"true/tranche=0"}
    history = store.open("dim_client", vanished)
    assert history.filter("est_courant").count() == 40 and history.count() == 41
    plan = history.filter("est_courant")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(est_courant" in plan


def test_a_history_written_without_ranges(spark, store):
    rows = {k: "a" for k in range(20)}
    first = scd.scd2_merge(None, stored(spark, rows), "client_id", "cle_client", DAY1)
    second = scd.scd2_merge(first, stored(spark, rows | {4: "b"}), "client_id", "cle_client", DAY2)
    old = store.write("dim_client", conform(second, "dim_client"), "est_courant")
    entry, opened = histories.load(store, "dim_client", stored(spark, rows | {4: "b", 9: "c"}), "client_id", "cle_client", DAY3, old, bits=3)
    history = store.open("dim_client", entry)
    assert opened == 1 and history.count() == 22 and history.filter("est_courant").count() == 20
