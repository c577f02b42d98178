"""Session zone and order days."""

from datetime import datetime

from conftest import collected
from tagloom import Settings
from tagloom.plans.metrics import METRICS


def test_order_day_follows_the_session_zone(tables, conf):
    def orders():
        return tables(
            restaurant_order_detail2=[
                ("o", "R1", datetime(2024, 5, 1, 17), 1.0, 1.0, "c"),
                ("o", "R1", datetime(2024, 5, 2, 1), 1.0, 1.0, "c"),
            ],
            itd_restaurant=[("R1", "zh-cn", "T2", None, None, None)],
            tb_order=[("o", 1, 1.0)],
        )

    assert collected(METRICS["rest_multitime"](orders(), Settings())) == [("1", "R1", False)]
    conf(spark__sql__session__timeZone="Asia/Shanghai")
    assert collected(METRICS["rest_multitime"](orders(), Settings())) == [("1", "R1", True)]
