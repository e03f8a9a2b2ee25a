from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from adlift.session import build_session  # noqa: E402

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "adlift-tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


CLICK = (
    "click_id string, impression_id string, timestamp timestamp, customer_id string, "
    "merchant_id string, ad_placement string"
)
ORDER = (
    "order_id string, timestamp timestamp, customer_id string, merchant_id string, "
    "order_amount double, used_coupon int, cuisine string"
)
VIEW = (
    "impression_id string, timestamp timestamp, customer_id string, merchant_id string, "
    "ad_placement string, advertiser_cuisine string, device string"
)


def click(cid, seconds, customer="u", merchant="m", impression="i0"):
    return (cid, impression, at(seconds), customer, merchant, "feed_banner_top")


def order(oid, seconds, customer="u", merchant="m", amount=10.0, coupon=0, cuisine="Pizza"):
    return (oid, at(seconds), customer, merchant, amount, coupon, cuisine)


def view(iid, seconds, customer="u", merchant="m", device="ios"):
    return (iid, at(seconds), customer, merchant, "feed_banner_top", "Pizza", device)
