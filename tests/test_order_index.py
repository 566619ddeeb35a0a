"""The streaming refresh opens only the days that its index names."""

import datetime as dt
import pathlib
import random

from granary.plans import jobs
from granary.schemas import ORDER_DETAILS
from granary.sources import scans
from granary.streaming import landing, order_index
from tests.test_jobs import land
from tests.test_payloads import order, product
from tests.test_stored import spoil
from tests.test_tables import deliveries, delivery, held

D = dt.date


def entries(spark, root, *orders):
    asked = spark.createDataFrame([(o,) for o in orders], f"{order_index.ORDER} bigint")
    return sorted((r[0], r[1].day) for r in order_index.days_of(spark, root, asked).collect())


def test_a_batch_opens_only_the_days_of_the_index(spark, tmp_path, rows):
    root, staging = str(tmp_path / "orders"), str(tmp_path / "staging")
    first = deliveries(spark, tmp_path / "1", *(delivery(d, d, (10, d)) for d in range(1, 8)))
    landing.refresh_batch(first, root, staging, 0)
    assert entries(spark, root, *range(1, 9)) == [(d, d) for d in range(1, 8)]
    # Days 1, 3, 5 and 6 cannot be read any more, not even for their order ids.
    spoil(root, *(f"order_date=2024-01-0{d}" for d in (2, 4, 7)))
    second = deliveries(spark, tmp_path / "2", delivery(2, 4, (10, 2)), delivery(7, 7, (11, 9)))
    landing.refresh_batch(second, root, staging, 1)
    left = [scans.read_parquet_table(spark, root, ORDER_DETAILS).filter(f"order_date = '2024-01-0{d}'") for d in (2, 4, 7)]
    got = [sorted((r.shipbob_order_id, r.inventory_id) for r in x.collect()) for x in left]
    assert got == [[], [(2, 10), (4, 10)], [(7, 11)]]
    assert entries(spark, root, 2, 4, 7) == [(2, 4), (4, 4), (7, 7)]


def test_random_batches_equal_a_table_kept_in_memory(spark, tmp_path, rows):
    """Orders come again, move, lose their items, and batches are run twice."""
    root, staging, rng, table = str(tmp_path / "orders"), str(tmp_path / "staging"), random.Random(1), {}
    for batch in range(4):
        sent = {o: (rng.randrange(1, 6), [(i, 1) for i in range(rng.randrange(0, 3))]) for o in rng.sample(range(8), 4)}
        docs = deliveries(spark, tmp_path / str(batch), *(delivery(o, d, *items) for o, (d, items) in sent.items()))
        for _ in range(1 + batch % 2):
            landing.refresh_batch(docs, root, staging, batch)
        table |= sent
        lines = sorted((D(2024, 1, d), o, i) for o, (d, items) in table.items() for i, _ in items)
        assert held(spark, root, rows) == [(d, o, i) for d, o, i in lines]
        assert entries(spark, root, *range(8)) == sorted((o, d) for o, (d, items) in table.items() if items)
        if batch == 2:
            before = len(list(pathlib.Path(order_index.path(root)).rglob("*.parquet")))
            order_index.compact(spark, root)
            assert len(list(pathlib.Path(order_index.path(root)).rglob("*.parquet"))) < before


def test_a_table_without_an_index_gets_one(spark, tmp_path, rows):
    root, staging = str(tmp_path / "orders"), str(tmp_path / "staging")
    shipments = [{"products": [product(1, 11)]}]
    landed = land(tmp_path, "o.json", order(1, shipments, {"id": 1, "name": "w"}), order(2, shipments, {"id": 1, "name": "w"}))
    jobs.ingest_orders(spark, landed, root, "2024-10-01", "2024-12-31")
    assert not order_index.exists(spark, root)
    landing.refresh_batch(deliveries(spark, tmp_path / "1", delivery(1, 1, (10, 2))), root, staging, 0)
    got = held(spark, root, rows)
    assert [(o, i) for _, o, i in got] == [(1, 10), (2, 11)] and got[0][0] == D(2024, 1, 1)
    # Another job writes to the table: the index is forgotten and built again.
    jobs.ingest_orders(spark, landed, root, "2024-10-01", "2024-12-31")
    assert not order_index.exists(spark, root)
    landing.refresh_batch(deliveries(spark, tmp_path / "2", delivery(1, 2, (12, 2))), root, staging, 1)
    assert [(o, i) for _, o, i in held(spark, root, rows)] == [(1, 12), (2, 11)]
