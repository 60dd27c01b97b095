"""Properties named in the survey's test strategy."""

from pyspark.sql import functions as F

from matchlake.operators import explode_child
from matchlake.plans import marts
from matchlake.plans.documents import conversation_docs
from matchlake.plans.registry import Tables


def test_flatten_then_renest_is_identity(spark):
    docs = conversation_docs(Tables(spark, "/root/testdata/sf0.001"))
    flat = explode_child(docs, "turns", keep=["conv_id", "first"], alias="t", expand=True)
    renested = flat.groupBy("conv_id", "first").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    assert docs.exceptAll(renested).count() == 0 and renested.exceptAll(docs).count() == 0


def test_first_kills_over_players_bounded_by_rounds(star):
    groups = star["kills"].select("matchid", "round").distinct().count()
    fk = marts.first_kills(star["kills"])
    assert fk.count() == groups                       # exactly one first kill per (match, round)
    per_player = fk.groupBy("killer_puuid").count().agg(F.sum("count")).first()[0]
    assert per_player <= groups                       # summed over players: never more than the rounds
    out = marts.first_event_ratio(star["player"], star["metadata"], star["kills"], roster=None)
    assert out.agg(F.max("first_blood")).first()[0] <= groups
