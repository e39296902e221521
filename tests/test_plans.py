"""Report rules on literal rows: order of prunes, class edges, schedules, fan-out and chosen readings."""

from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from freightmart.functions import literals as fixed
from freightmart.operators.sla import schedules, sla_verdict, working_minutes
from freightmart.plans import convergence, finance, prices, reconcile, reference, stock, tracking, warehouses, waybills

PRUNE = "request_number string, final_status string, platform_cancelled int, route string, load_address string, unload_address string"


def test_prunes_run_in_order(spark):
    rows = [
        ("done", "Доставлен", 0, "r1", None, None), ("done", "В пути", 0, "r2", None, None), ("done", None, 0, "r3", None, None),
        ("cancel", "Отмена", 1, None, None, None), ("cancel", "В пути", 0, "r", None, None),
        ("both", "Выполнена", 0, "r", None, None), ("both", "Отмена", 1, "q", None, None),
        ("empty", "В пути", 0, "r", None, None), ("empty", "В пути", 0, None, None, None),
        ("alone", "В пути", 0, None, None, None),
        # the second row falls to the first prune, so the empty row is the only one left and stays
        ("last", "Доставлен", 0, None, None, None), ("last", "В пути", 0, "r", None, None),
        (None, "В пути", 0, None, None, None), (None, "В пути", 0, None, None, None),
    ]
    got = Counter((r.request_number, r.final_status, r.route) for r in tracking.prune(spark.createDataFrame(rows, PRUNE)).collect())
    assert got == Counter({
        ("done", "Доставлен", "r1"): 1, ("done", None, "r3"): 1, ("cancel", "Отмена", None): 1, ("both", "Выполнена", "r"): 1,
        ("empty", "В пути", "r"): 1, ("alone", "В пути", None): 1, ("last", "Доставлен", None): 1, (None, "В пути", None): 2})


def test_trailer_class_edges(spark):
    cases = [("STANDARD", "24", "1", "20 т"), ("STANDARD", "24.1", "1", "Прочие"), ("CIRCULAR", "3", "1", "1,5 т"), ("COMPLEX", "9", "1", "3,5 т"),
             ("STANDARD", "1", "16", "20 т"), ("STANDARD", None, "1", "Прочие"), ("OTHER", "1", "1", "Прочие")]
    rows = [(a, None if b is None else Decimal(b), Decimal(c), d) for a, b, c, d in cases]
    df = spark.createDataFrame(rows, "t string, w decimal(10,2), l decimal(10,2), want string")
    got = df.select("want", finance.trailer_class(F.col("t"), F.lit("Автотранспорт"), F.col("w"), F.col("l")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    other = df.select(finance.trailer_class(F.col("t"), F.lit("Авиа"), F.col("w"), F.col("l")).alias("g")).distinct().collect()
    assert [r.g for r in other] == ["Нет данных"]


def test_warehouse_classes(spark):
    zero = fixed.ZERO_REF
    rows = [("1", "склад 4 PL СО СУ", "u", "b", "d", "p", False, True), ("2", "Рэйл", zero, "b", "d", "none", False, True),
            ("3", "склад", zero, "b", "d", "p", False, True), ("4", "склад", None, "b", "none", "p", False, True), ("5", "склад", "u", "b", "d", "p", True, True)]
    houses = spark.createDataFrame(rows, "ref string, name string, usage string, branch string, department string, person string, deleted boolean, is_group boolean")
    d = lambda ref, name: spark.createDataFrame([(ref, name)], "ref string, name string")
    got = warehouses.classify_warehouses(houses, d("b", "северо-западный"), d("d", "управление"), d("p", "Иванов"))
    assert {r.warehouse_ref: (r.format, r.owner, r.kind, r.branch_short, r.person) for r in got.collect()} == {
        "1": ("4PL", "ЛТС", "СО", "СЗ", "Иванов"), "2": ("ОХ", "АБЛ", "ЗАВОД", "СЗ", "Заводы ЖДРМ"), "3": ("ОХ", "ЖДРМ", "ЗАВОД", "СЗ", "Иванов")}


def test_working_minutes_before_within_and_after_hours(spark):
    t = datetime
    rows = [
        ("before", t(2023, 1, 2, 5), t(2023, 1, 2, 9)), ("within", t(2023, 1, 2, 10), t(2023, 1, 3, 8)),
        ("after", t(2023, 1, 2, 22), t(2023, 1, 3, 8)), ("weekend", t(2023, 1, 6, 10), t(2023, 1, 9, 10)), ("none", t(2023, 1, 2, 10), t(2023, 1, 2, 11))]
    names = {"weekend": "08:00-17:00, 5 дней в неделю", "none": None}
    df = spark.createDataFrame([(n, s, e, names.get(n, "07:00-19:00, 7 дней в неделю")) for n, s, e in rows],
                               "n string, s timestamp_ntz, e timestamp_ntz, schedule string")
    now = F.lit("2023-01-02 12:00:00").cast("timestamp_ntz")
    got = {r.n: (r.work_case, r.work_minutes, r.order_weekday) for r in working_minutes(df, "s", "e", now, now).collect()}
    assert got["before"] == ("before", 120, 1)
    assert got["within"] == ("within", 22 * 60 - 720, 1)
    assert got["after"] == ("after", 60, 1)
    assert got["weekend"] == ("within", 3 * 24 * 60 - 3 * 900, 5)  # weekend days cost the same as working days
    assert got["none"][0] is None
    verdicts = spark.createDataFrame([("Отгружен", 420), ("Отгружен", 421), ("Отгружен", -1), (None, 5)], "st string, m int").select(
        sla_verdict(F.col("st"), F.col("m")).alias("v"))
    assert [r.v for r in verdicts.collect()] == [fixed.SLA_IN_TIME, fixed.SLA_LATE, fixed.SLA_LATE, fixed.SLA_IN_WORK]
    for s in schedules(spark).collect():
        assert s.off_minutes == 1440 - (s.close_minute - s.open_minute)


def test_catalogue_ties_multiply_and_zero_prices_give_way(spark):
    day = datetime(2023, 1, 1)
    catalogue = spark.createDataFrame([("a", Decimal(5), day), ("a", Decimal(6), day), ("b", Decimal(0), day)], "item string, price decimal(10,2), period timestamp_ntz")
    lines = spark.createDataFrame([("s", "b", Decimal(7)), ("s", "c", Decimal(1)), ("s", "a", Decimal(9))], "shipment string, item string, price decimal(10,2)")
    links = spark.createDataFrame([("i", "s"), ("i", "s")], "issue_order string, shipment string")
    orders = spark.createDataFrame([("i", False, "w", day)], "ref string, deleted boolean, warehouse string, issued_at timestamp_ntz")
    houses, mapping = spark.createDataFrame([("w", "W")], "ref string, name string"), spark.createDataFrame([("W", "B", "СУ")], "name string, branch string, kind string")
    args = (catalogue, lines, links, orders, houses, mapping)
    assert sorted((r.item, int(r.price)) for r in prices.price_list(*args).collect()) == [("a", 5), ("a", 6), ("b", 7)]
    single = prices.price_list(*args, keep_ties=False, drop_zero=False)
    assert sorted((r.item, int(r.price)) for r in single.collect()) == [("a", 6), ("b", 0)]


def test_stock_reconciliation_keeps_both_one_sided_rows(spark):
    left = spark.createDataFrame([("ib", "g1", "x", None, "a", "c", "1", "Без серии", "pc", 5.0), ("ib", "g1", "y", "a", None, "c", "2", "S", "pc", 3.0)],
                                 "base string, warehouse_ref string, item string, article string, article_alt string, code string, item_id string, series string, unit string, quantity double")
    links = spark.createDataFrame([("g1", "W", "B"), ("g2", "-", "B")], "customer_ref string, warehouse string, own_base string")
    right = spark.createDataFrame([("W", "room", "x", "a", "c", "1", "партия б/н", "pc", "5,0"), ("W", "room", "z", "a", "c", "3", "S от 1.1", "pc", "1 000,5"),
                                   ("W", "other", "q", "a", "c", "4", "S", "pc", "1")],
                                  "warehouse string, room string, item string, article string, code string, item_id string, series string, unit string, quantity string")
    equipment = spark.createDataFrame([("3", True)], "item_id string, is_line boolean")
    got = stock.stock_reconciliation(left, links, right, equipment, ["room"])
    assert sorted((r["item"], r.series, float(r.difference), r.is_line) for r in got.collect()) == [("y", "S", 3.0, False), ("z", "S", -1000.5, True)]


def test_attached_files_take_the_least_sent_state(spark):
    files = spark.createDataFrame([("1", "d", "pdf"), ("2", "d", "jpg"), ("3", "e", "pdf"), ("4", "f", "doc")], "ref string, owner string, extension string")
    sent = spark.createDataFrame([("1", True), ("2", False), ("3", True)], "file string, is_sent boolean")
    got = {r.owner: (r.extensions, r.is_sent) for r in reconcile.attached_files(files, sent).collect()}
    assert got == {"d": ("jpg", False), "e": ("pdf", True), "f": ("doc", False)}


def test_both_last_movement_kinds_are_checked(spark):
    kinds = ["Внутреннее потребление товаров", "Отгрузка товаров с хранения", "Другое"]
    moves = spark.createDataFrame([(k, k, "Нет", "Да") for k in kinds], "document_id string, kind string, deleted string, posted string")
    archive = spark.createDataFrame([], "document_id string, archive_document string, archive_deleted string, has_file string, approval_own string, approval_office string, comment string")
    got = convergence.convergence_movements(moves, archive)
    assert {(r.kind, r.error_code) for r in got.collect()} == {(k, "1") for k in kinds[:2]}


def test_import_prefers_unknown_then_heaviest_weight(spark):
    rows = spark.createDataFrame([("12", "A.0", "n", "kg", 3.0), ("12", "A.0", "n", "kg", 5.0), ("7", "B", "m", "kg", None), ("7", "B", "m", "kg", 1.0)],
                                 "code string, article string, name string, unit string, weight double")
    assert {(r.code, r.article, r.weight) for r in reference.import_items(rows).collect()} == {("000000012", "A", 5.0), ("000000007", "B", None)}


def test_packages_prefer_valid_then_newest(spark):
    day = lambda d: datetime(2023, 1, d)
    packages = spark.createDataFrame([("p1", "r", "q", day(5), False, True, "e"), ("p2", "r", "q", day(1), True, True, "e"), ("p3", "r", "q", day(2), True, False, "e")],
                                     "package string, route string, request string, received_at timestamp_ntz, is_valid boolean, processed boolean, error string")
    d = lambda ref, number: spark.createDataFrame([(ref, number)], "ref string, number string")
    lines = spark.createDataFrame([("r", "q")], "route string, request string")
    got = waybills.incoming_packages(packages, d("r", "ML1"), lines, d("q", "Z1")).collect()
    assert [(r.key, r.package) for r in got] == [("ML1/Z1", "p3")]


def test_consolidation_address_moves_a_new_request(spark):
    address, name = fixed.CONSOLIDATION_ADDRESSES[0]
    rows = [("Новая", address, "x", None, "a"), ("Новая", address, address, None, "a"), ("В пути", address, "x", "W", "a"), ("Новая", "y", "x", "W", "a")]
    df = spark.createDataFrame(rows, "final_status string, request_load_address string, request_unload_address string, consolidation_warehouse string, stage string")
    got = [(r.consolidation_warehouse, r.stage) for r in tracking.start_at_consolidation(df).collect()]
    assert Counter(got) == Counter([(name, fixed.STAGE_CONSOLIDATION), (None, "a"), ("W", "a"), ("W", "a")])


def test_status_order_of_both_systems(spark):
    df = spark.createDataFrame([("SHIPPED", "CANCELED", None), (None, "SHIPPED_AND_CONFIRMED", None), (None, "OTHER", "IN_PROGRESS"), (None, None, None)],
                               "t string, o string, n string")
    got = [r.s for r in df.select(tracking.platform_status(F.col("t"), F.col("o"), F.col("n")).alias("s")).collect()]
    assert got == ["Доставлено", "Выполнена", "На редукционе", None]
    df = spark.createDataFrame([("В пути", "Доставлен"), ("Консолидация", "Отменено заказчиком"), (None, "В работе"), ("Доставлен", "Отменено заказчиком")], "r string, h string")
    got = [r.s for r in df.select(tracking.dispatch_status(F.col("r"), F.col("h")).alias("s")).collect()]
    assert got == ["Доставлен", "Отменено заказчиком", "В работе", "Доставлен"]
