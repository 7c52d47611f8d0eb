from decimal import Decimal

import pytest
from support_core import plan, rows

from stratalake.functions import governance as gov

DATA = [
    (1, "anna@x.com", "+1 (555) 123-4567", Decimal("10.00"), "EU"),
    (2, "b", "12", Decimal("20.00"), "US"),
    (3, None, None, None, "JP"),
    (4, "c@y@z", "5551234", Decimal("1.50"), "LATAM"),
    (5, "@only", "", Decimal("2.00"), None),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(DATA, "id INT, email STRING, phone STRING, total_revenue DECIMAL(10,2), region STRING")


@pytest.mark.parametrize(
    "groups,ids",
    [
        ([], []),
        (["pii_viewers"], []),
        (["emea_team"], [1]),
        (["na_team"], [2]),
        (["apac_team"], [3]),
        (["emea_team", "na_team"], [1, 2]),
        (["global_admins"], [1, 2, 3, 4, 5]),
    ],
)
def test_rows_by_group(table, groups, ids):
    view = gov.secure_view(table, gov.CUSTOMER_ANALYTICS, groups)
    assert [r["id"] for r in view.orderBy("id").collect()] == ids


def test_masks(table):
    view = gov.secure_view(table, gov.CUSTOMER_ANALYTICS, ["global_admins"])
    assert rows(view.select("id", "email", "phone", "total_revenue"), "id") == [
        (1, "an****@x.com", "***-***-4567", None),
        (2, "****@", "***-***-12", None),
        (3, None, None, None),
        (4, "c@****@y", "***-***-1234", None),
        (5, "@o****@only", "***-***-", None),
    ]


def test_privileged_groups_see_values(table):
    view = gov.secure_view(table, gov.CUSTOMER_ANALYTICS, ["global_admins", "pii_viewers", "finance_team"])
    assert rows(view) == sorted(DATA, key=repr)


def test_tags(table):
    view = gov.secure_view(table, gov.CUSTOMER_ANALYTICS, ["global_admins"])
    assert gov.column_tags(view) == {
        "email": {"pii": "true", "sensitivity": "high"},
        "phone": {"pii": "true", "sensitivity": "high"},
    }


@pytest.mark.parametrize("groups", [[], ["global_admins"], ["emea_team", "pii_viewers"], ["na_team", "finance_team"]])
def test_sql_functions_agree_and_are_inlined(spark, table, groups):
    gov.register_mask_functions(spark, groups)
    sql = spark.sql(
        """SELECT id, mask_email(email) AS email, mask_phone(phone) AS phone,
             mask_revenue(total_revenue) AS total_revenue, region FROM {t} WHERE filter_by_region(region)""",
        t=table,
    )
    assert rows(sql) == rows(gov.secure_view(table, gov.CUSTOMER_ANALYTICS, groups))
    assert "mask_email(" not in plan(sql, "simple")
