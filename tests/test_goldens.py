"""Known answers of the three sample pairs, on rows made up around their known differences."""

import pytest
from conftest import values

from evenkeel import ColumnMap, Mapping
from evenkeel.operators import repair
from evenkeel.plans.reconcile import reconcile
from evenkeel.plans.validation import Validation

NAMES = "cust_id first_nm last_nm city_nm state_nm age_val salary_amt dept_nm join_dt status_cd"
TARGET_NAMES = "customer_id first_name last_name city state age salary department join_date status"


def customer(i, **change):
    row = {
        "cust_id": str(i),
        "first_nm": f"First{i}",
        "last_nm": f"Last{i % 7}",
        "city_nm": "Mysore" if i == 1002 else "Pune",
        "state_nm": "Karnataka",
        "age_val": str(20 + i % 30),
        "salary_amt": "82000" if i == 1005 else str(i * 10),
        "dept_nm": "IT",
        "join_dt": f"2022-01-{1 + i % 28:02d}",
        "status_cd": "ACTIVE",
    }
    return tuple({**row, **change}.values())


@pytest.fixture
def customers(text):
    source = text(NAMES, [customer(i) for i in range(1001, 1026)])
    changes = {
        1002: {"city_nm": "Mysuru"},
        1005: {"salary_amt": "85000"},
        1007: {"dept_nm": "Technology"},
        1009: {"status_cd": "INACTIVE"},
    }
    kept = [i for i in range(1001, 1028) if i not in (1024, 1025)]
    target = text(TARGET_NAMES, [customer(i, **changes.get(i, {})) for i in kept])
    mapping = Mapping.of(
        ["cust_id"], [ColumnMap(s, t) for s, t in zip(NAMES.split(), TARGET_NAMES.split())]
    )
    return source, target, mapping


def counters(checks):
    return {(r.validation_name, r.counter): (r.value, r.status) for r in checks.collect()}


def test_customers_validation(customers):
    with Validation(*customers) as run:
        assert values(run.extra_in_source) == [("1024",), ("1025",)]
        assert values(run.extra_in_target) == [("1026",), ("1027",)]
        assert values(run.mismatch_long) == [
            ("1002", "city_nm", "Mysore", "Mysuru"),
            ("1005", "salary_amt", "82000", "85000"),
            ("1007", "dept_nm", "IT", "Technology"),
            ("1009", "status_cd", "ACTIVE", "INACTIVE"),
        ]
        wide = {r.cust_id: r.mismatched_columns for r in run.mismatch_wide.collect()}
        assert wide == {
            "1002": "city_nm",
            "1005": "salary_amt",
            "1007": "dept_nm",
            "1009": "status_cd",
        }
        assert run.matched_keys.count() == 23
        seen = counters(run.checks)
        assert seen["row_count_validation", "source_row_count"] == (25, "PASS")
        assert seen["source_duplicate_key_validation", "duplicate_key_count"] == (0, "PASS")
        assert seen["hash_mismatch_validation", "mismatch_record_count"] == (4, "FAIL")
        assert run.overall_status.first()[0] == "FAIL"
        summary = run.summary.first()
        assert (summary.source_count, summary.mismatch_field_count) == (25, 4)
        assert (summary.row_count_status, summary.overall_status) == ("PASS", "FAIL")


def test_customers_repair(customers):
    source, target, mapping = customers
    done = reconcile(source, target, mapping)
    assert tuple(done.summary.first()) == (25, 25, 4, 4, 2, 2, 0)
    assert {r.status for r in done.after.checks.collect()} == {"PASS"}
    assert values(done.repaired) == values(source)
    settled = reconcile(source, target, mapping, settle_plan=True)
    assert values(settled.repaired) == values(source)
    details = repair.repair_details(done.plan, mapping, "update")
    assert values(details)[0] == ("1002", "city_nm")
    assert values(repair.repair_details(done.plan, mapping, "delete")) == [("1026",), ("1027",)]


@pytest.fixture
def numbers(text):
    source = [(str(i), str(i * 100), f"N{i}") for i in (1, 2, 3, 4, 5, 6, 8, 9)]
    source[3] = ("4", "400", "Anu")
    source += [("7", "700", "N7"), ("7", "700", "N7")]
    target = [(f"{i}.0", f"{i * 100}.0", f"  N{i}  ") for i in (1, 2, 3, 4, 5, 6, 8, 9)]
    target[2] = ("3.0", "350.0", "N3")
    target[3] = ("4", "400", "Anu Sharma")
    target += [("10", "1", "x"), ("10.00", "1", "x")]
    mapping = Mapping.of(
        ["cust_id"],
        [
            ColumnMap("cust_id", "customer_id", "numeric"),
            ColumnMap("price", "price_amt", "numeric"),
            ColumnMap("first_nm", "first_name"),
        ],
    )
    return (
        text("cust_id price first_nm", source),
        text("customer_id price_amt first_name", target),
        mapping,
    )


@pytest.mark.parametrize("settled", [False, True])
def test_canonical_numbers(numbers, settled):
    with Validation(*numbers, settled=settled) as run:
        assert values(run.duplicate_keys("source")) == [("7", 2)]
        assert values(run.duplicate_keys("target")) == [("10", 2)]
        assert values(run.extra_in_source) == [("7",)]
        assert values(run.extra_in_target) == [("10",)]
        assert run.matched_keys.count() == 8
        assert values(run.mismatch_long) == [
            ("3", "price", "300", "350.0"),
            ("4", "first_nm", "Anu", "Anu Sharma"),
        ]


def test_typed_orders(spark):
    """Tables with native types and equal names on both sides."""
    schema = "order_id int, customer_name string, amount decimal(10,2), status string"
    source = spark.sql(
        "select * from values (1, 'A', 100.00bd, 'NEW'), (2, 'B', 850.00bd, 'NEW'), "
        f"(3, 'C', 5.00bd, 'NEW') as t({', '.join(c.split()[0] for c in schema.split(', '))})"
    )
    target = source.filter("order_id < 3").unionByName(
        spark.sql(
            "select 4 order_id, 'D' customer_name, cast(1.00 as decimal(5,2)) amount, 'NEW' status"
        )
    )
    target = target.selectExpr(
        "order_id", "customer_name", "if(order_id = 2, 900.00bd, amount) amount", "status"
    )
    mapping = Mapping.of(
        ["order_id"],
        [
            ColumnMap("order_id", "order_id", "integer"),
            ColumnMap("customer_name", "customer_name"),
            ColumnMap("amount", "amount", "numeric"),
            ColumnMap("status", "status"),
        ],
    )
    run = Validation(source, target, mapping)
    assert values(run.extra_in_source) == [(3,)]
    assert values(run.extra_in_target) == [(4,)]
    assert values(run.mismatch_long) == [(2, "amount", "850.00", "900.00")]
