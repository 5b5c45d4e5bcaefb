"""Dashboard boards over marts written by the batch and streaming jobs."""

from __future__ import annotations

from helpers import SF_SMALL
from navstream.plans import catalog as K
from navstream.plans.serving_job import batch_boards, stream_boards
from navstream.plans.stream_job import start_streaming
from navstream.settings import ServingSettings, StreamSettings
from navstream.sources import standins
from navstream.streaming.pipeline import drain


def test_batch_boards_over_job_output(spark):
    layout = K.batch_job_output(spark, SF_SMALL)
    boards = batch_boards(spark, layout.output_dir, settings=ServingSettings(top_k=7, trend_top_k=3))
    months = [r["month"] for r in boards["months"].collect()]
    assert months == sorted(months, reverse=True)
    inbound = boards["top_inbound"].collect()
    assert 0 < len(inbound) <= 7 and {r["month"] for r in inbound} == {months[0]}
    assert {r["month"] for r in boards["top_outbound"].collect()} <= {months[0]}
    assert all(r["link"] == f"{r['prev']}  →  {r['curr']}" for r in boards["top_pairs"].collect())
    assert boards["trend_of_leaders"].select("curr").distinct().count() == 3
    picked = batch_boards(spark, layout.output_dir, month=months[-1])["top_inbound"].collect()
    assert {r["month"] for r in picked} == {months[-1]}


def test_stream_boards_over_stream_output(spark, workdir):
    ensure = K._event_record_stream(spark, SF_SMALL)
    settings = StreamSettings(output_dir=str(workdir / "out"), checkpoint_dir=str(workdir / "chk"))
    drain(start_streaming(spark, settings, records=ensure, available_now=True, console=False))
    boards = stream_boards(spark, settings.output_dir, ServingSettings(editors_top_k=5))
    (kpi,) = boards["kpis"].collect()
    events = standins.table(spark, SF_SMALL, "events").count()
    assert 0 < kpi["total_edits"] <= events and kpi["total_bots"] <= kpi["total_edits"]
    assert boards["rate_series"].count() > 0
    assert sum(r["count"] for r in boards["type_totals"].collect()) == boards["type_series"].agg({"count": "sum"}).first()[0]
    assert boards["top_editors"].count() <= 5
