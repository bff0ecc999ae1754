from pyspark.sql import functions as F

from tabforge.llm import url_filter
from tabforge.llm.common import table

JUNK = {"casino-win", "free-bets", "cheap-pills", "adult-x", "spam-farm", "ads-track"}


def _site():
    return F.regexp_replace(F.regexp_replace("host", r"(\.example)?\.[^.]*$", ""), r"^(www|m|blog)\.", "")


def test_no_site_of_the_given_tables_is_a_training_row(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        hosts = table(spark, f"/root/testdata/{sf}", "pages").select(url_filter.host_of(F.col("url")).alias("host"))
        sites = {r[0] for r in hosts.select(_site()).distinct().collect()}
        assert JUNK <= sites or sf != "sf0.1"
        assert not sites & {*url_filter.BLOCKED_SITES, *url_filter.ALLOWED_SITES}


def test_verdicts_of_the_model_on_held_out_sites(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    pages = url_filter.judged(table(spark, "/root/testdata/sf0.1", "pages"), model)
    share = {r[0]: r[1] for r in pages.groupBy(_site()).agg(F.avg((F.col("p_block") >= 0.5).cast("int"))).collect()}
    assert all(v == 0 for s, v in share.items() if s not in JUNK)
    assert all(share[s] >= 0.5 for s in JUNK)
