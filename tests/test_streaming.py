from tests.conftest import ROWS, changed, write_csv
from tillstar.schemas import RAW_COLUMNS
from tillstar.sources.store import FACTS, Store
from tillstar.streaming.arrivals import load_arrivals


def test_arrivals_are_loaded_once(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", str(tmp_path / "warehouse")
    landing.mkdir()
    write_csv(landing / "day1.csv", ROWS[:2])

    def catch_up(checkpoint):
        query = load_arrivals(spark, str(landing), warehouse, str(tmp_path / checkpoint), files_per_batch=1)
        query.awaitTermination(240)
        assert query.exception() is None

    catch_up("c1")
    store = Store(spark, warehouse)
    assert store.read(FACTS).count() == 2
    # the columns of the second file come in the opposite order
    day2 = [ROWS[2], changed(ROWS[0], Row_ID="9", Order_ID="ORD-78-1", Order_Date="2023-01-01", Ship_Date="2023-01-02", Segment="Home Office")]
    write_csv(landing / "day2.csv", [r[::-1] for r in day2], columns=RAW_COLUMNS[::-1])
    catch_up("c1")
    assert store.read(FACTS).count() == 4
    assert store.read("dim_customer").filter("customer_id = 'NL-204'").count() == 2
    # a fresh checkpoint delivers everything again
    catch_up("c2")
    assert store.read(FACTS).count() == 4
