"""Own documents against the customer's, with the reason why they do not agree.

Three variants: 4PL orders, own-storage orders (repeated lines paired by their
position), and the movement register.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.ladder import Ladder, Rule, yes_no
from ..functions.semantics import has_ref, is_false, is_true
from ..operators.joins import lookup
from ..operators.ordinal import pair_by_ordinal
from ..session import cut_lineage

# Error texts
INCOMPLETE = "Неполный комплект первичных документов"
BAD_PAPERS = "Некорректное оформление первичных документов"
WRONG_DOCUMENT = "Ошибка в системном и/или первичном документе"
BAD_SCANS = "Неудовлетворительное качество «скан-образов» первичных документов"
MISMATCH = "Несоответствие предоставленных первичных документов, документу, заведенному в 1С"
NOT_PASSED = "Системный документ не прошел контроль"
RETURNED = "Возврат на доработку по инициативе функционального подразделения"
NOT_POSTED = "Системный документ не проведен в оперативном управленческом учете программы 1С:ЕРП ЛТС"
PERIOD_CLOSED = "Период закрыт. Документы не могут быть приняты к учету"
NO_SYSTEM_DOCUMENT = "Отсутствует системный документ"
NO_LINKS = "Отсутсвуют связи с документом"
DELETED_THERE = "Заказ удален в базе ЛокоТех и не удален в базе Салаир"
CANCELLED_HERE = "Заказ отменен в базе Салаир и не удален в базе ЛокоТех"
RECEIPT_DELETED = "Удалено поступление товаров на склад в базе ЛокоТех"
QUANTITY = "Расхождение по количеству"
NO_ARCHIVE = "Не создан документ СЭА"
ARCHIVE_DELETED = "Удален документ СЭА"
NO_SCAN = "Не вложен скан в документ СЭА"
UNKNOWN_ITEM = "Номенклатура не соответсвует справочнику НСИ в ЛТ"
NOT_POSTED_HERE = "Не проведен Заказ в базе Салаир"
NOT_POSTED_THERE = "Заказ не проведен и не удален в базе ЛокоТех"
OTHER_ERRORS = "Прочие ошибки"

# Archive comment patterns per variant, in order, as (pattern, code, text)
COMMENTS_4PL = [
    ("1)%", "8", INCOMPLETE), ("2)%Некорректное%", "9", BAD_PAPERS), ("2)%Ошибка%", "10", WRONG_DOCUMENT),
    ("3)%Неудовлетворительное%", "11", BAD_SCANS), ("3)%Несоответствие%", "12", MISMATCH), ("4)%", "11", BAD_SCANS),
    ("5)%", "13", NOT_PASSED), ("6)%", "14", RETURNED), ("Системный документ не проведен%", "15", NOT_POSTED),
]
COMMENTS_OWN = [
    ("1)%", "6", INCOMPLETE), ("2)%Некорректное%", "7", BAD_PAPERS), ("2)%Ошибка%", "8", WRONG_DOCUMENT),
    ("3)%Несоответствие%", "9", MISMATCH), ("3)%Неудовлетворительное%", "10", BAD_SCANS), ("4)%", "11", RETURNED),
    ("5)%", "12", NOT_PASSED), ("6)%", "11", RETURNED), ("7)%", "13", PERIOD_CLOSED), ("8)%", "14", NO_SYSTEM_DOCUMENT),
    ("9)%", "15", NO_LINKS),
]
COMMENTS_MOVES = [
    ("1)%", "4", INCOMPLETE), ("2)%Некорректное%", "5", BAD_PAPERS), ("2)%Ошибка%", "6", WRONG_DOCUMENT),
    ("3)%Неудовлетворительное%", "7", BAD_SCANS), ("3)%Несоответствие%", "8", MISMATCH), ("4)%", "9", BAD_SCANS),
    ("5)%", "10", NOT_PASSED), ("6)%", "11", RETURNED),
]


def _comment_rules(patterns: list[tuple[str, str, str]]) -> list[Rule]:
    return [Rule(F.col("comment").like(pattern), code, text) for pattern, code, text in patterns]


def _agreed() -> Column:
    """Both approvals and the archive comment say "agreed"."""
    return (
        (F.col("approval_own") == fixed.AGREED) & (F.col("approval_office") == fixed.AGREED)
        & (F.col("comment") == fixed.AGREED)
    )


def issued_per_order(issues: DataFrame, lines: DataFrame, items: DataFrame) -> DataFrame:
    """Issue orders that belong to a customer order, summed per item.

    ``issues``: ref, order, number, day, deleted. ``lines``: doc, item,
    quantity. ``items``: ref, item_id.
    """
    rows = issues.where(has_ref("order")).select("ref", "order", F.col("number").alias("issue_number"),
                                                  F.col("day").alias("issue_day"), F.col("deleted").alias("issue_deleted"))
    rows = rows.join(lines, F.col("ref") == F.col("doc"), "left")
    rows = lookup(rows, items, "item", "ref", {"item_id": "item_id"})
    return rows.groupBy("order", "issue_number", "issue_day", "issue_deleted", "item", "item_id").agg(
        F.sum("quantity").alias("quantity")
    )


def _errors(rows: DataFrame, ladder: Ladder) -> DataFrame:
    return rows.where(F.col("has_error") == fixed.YES).select(
        ladder.text().alias("error"), ladder.code().alias("error_code"), *rows.columns
    )


def convergence_4pl(orders: DataFrame, issued: DataFrame, partner: DataFrame, archive: DataFrame) -> DataFrame:
    """4PL orders that do not agree with the customer's system.

    ``orders``: ref, order_id, warehouse, number, day, deleted, cancelled,
    posted. ``issued`` from ``issued_per_order``. ``partner``: partner_id,
    partner_deleted, receipt_deleted, partner_item, partner_quantity,
    archive_id. ``archive``: archive_id, archive_document, archive_deleted,
    has_file, approval_own, approval_office, comment.

    The final look back at the orders repeats a row when several orders share
    an order id, as the report has always done.
    """
    # both sides are kept before they meet: the disk holds the shuffles of one of them at a time
    own = cut_lineage(orders.join(issued.withColumnRenamed("order", "ref"), "ref", "left"))
    other = cut_lineage(partner.join(archive, "archive_id", "left"))
    rows = own.join(other, (own["order_id"] == other["partner_id"]) & (own["item_id"] == other["partner_item"]), "left")
    no, yes = fixed.NO, fixed.YES
    deleted, cancelled, posted = F.col("deleted"), F.col("cancelled"), F.col("posted")
    fine = (
        is_false(deleted) & is_false(cancelled) & is_true(posted) & (F.col("quantity") == F.col("partner_quantity"))
        & (F.col("partner_deleted") == no) & (F.col("receipt_deleted") == no) & (F.col("archive_deleted") == no)
        & (F.col("has_file") == yes) & _agreed()
    )
    gone = (
        (is_true(cancelled) & F.col("partner_id").isNull())
        | (is_true(deleted) & (F.col("partner_deleted") == yes))
        | (is_true(cancelled) & is_true(posted) & (F.col("receipt_deleted") == yes) & (F.col("archive_deleted") == yes))
    )
    rows = rows.withColumn("has_error", yes_no(F.coalesce(fine, F.lit(False)) | F.coalesce(gone, F.lit(False)), no, yes))
    ladder = Ladder([
        Rule(is_false(deleted) & (F.col("partner_deleted") == yes), "1", DELETED_THERE),
        Rule(F.col("warehouse").isNull() & F.col("partner_id").isNull(), "1", DELETED_THERE),
        Rule(is_true(cancelled) & (F.col("partner_deleted") == no), "2", CANCELLED_HERE),
        Rule(F.col("receipt_deleted") == yes, "3", RECEIPT_DELETED),
        Rule(F.col("quantity") != F.col("partner_quantity"), "4", QUANTITY),
        Rule(F.col("archive_document").isNull(), "5", NO_ARCHIVE),
        Rule(F.col("has_file") == no, "6", NO_SCAN),
        Rule(F.col("order_id").isNull() | F.col("partner_id").isNull(), "7", UNKNOWN_ITEM),
        *_comment_rules(COMMENTS_4PL),
        Rule(is_false(deleted) & is_false(cancelled) & is_false(posted), "16", NOT_POSTED_HERE),
    ], ("17", OTHER_ERRORS))
    errors = _errors(rows, ladder)
    repeats = orders.groupBy("order_id", F.col("warehouse").alias("order_warehouse")).agg(F.count(F.lit(1)).alias("__times"))
    placed = errors.withColumn("__id", F.coalesce("order_id", "partner_id")).join(
        repeats.withColumnRenamed("order_id", "__id"), "__id", "left"
    )
    return placed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.coalesce("__times", F.lit(1)).cast("int")))).drop(
        "__id", "__times", "__copy"
    )


def convergence_own_storage(orders: DataFrame, issued: DataFrame, partner: DataFrame, archive: DataFrame) -> DataFrame:
    """Own-storage orders that do not agree; the n-th smallest line meets the n-th smallest line.

    ``orders``: ref, order_id, warehouse, deleted. ``partner``: partner_id,
    partner_deleted, partner_posted, partner_item, partner_quantity,
    archive_id. ``archive``: archive_id, archive_document, has_file,
    approval_own, approval_office, comment. Rules without a match give NULL.
    """
    own = orders.join(issued.withColumnRenamed("order", "ref"), "ref", "left").drop("ref", "item", "issue_day")
    other = partner.join(archive, "archive_id", "left").withColumns({
        "order_id": F.col("partner_id"), "item_id": F.col("partner_item")}).drop("archive_id")
    # a NULL order or item keeps its own row, it just never meets a partner
    rows = pair_by_ordinal(own, other, ["order_id", "item_id"], ["quantity"], ["partner_quantity"], out="position")
    no, yes = fixed.NO, fixed.YES
    deleted = F.col("deleted")
    known, gone_there = F.col("partner_id").isNotNull(), F.col("partner_deleted") == yes
    archived = F.col("archive_document").isNotNull()
    # File marks of this archive
    has_file, no_file = "Есть файл", "Нет файла"
    fine = (
        is_false(deleted) & (F.col("quantity") == F.col("partner_quantity")) & (F.col("partner_deleted") == no)
        & (F.col("partner_posted") == yes) & (F.col("has_file") == has_file) & _agreed()
    )
    gone = is_true(deleted) & (~known | (gone_there & (~archived | _agreed())))
    rows = rows.withColumn("has_error", yes_no(F.coalesce(fine, F.lit(False)) | F.coalesce(gone, F.lit(False)), no, yes))
    kept_there = is_false(deleted) & known & (F.col("partner_deleted") == no)
    ladder = Ladder([
        Rule(is_false(deleted) & (~known | gone_there), "1", DELETED_THERE),
        Rule(is_true(deleted) & (F.col("partner_deleted") == no), "2", CANCELLED_HERE),
        Rule(F.col("quantity") != F.col("partner_quantity"), "3", QUANTITY),
        Rule(kept_there & ~archived, "4", NO_ARCHIVE),
        Rule(kept_there & archived & (F.col("has_file") == no_file), "5", NO_SCAN),
        *_comment_rules(COMMENTS_OWN),
        Rule(F.col("approval_office") != fixed.AGREED, "17", OTHER_ERRORS),
        Rule(is_false(deleted) & (F.col("partner_deleted") == no) & (F.col("partner_posted") == no), "16", NOT_POSTED_THERE),
    ])
    return _errors(rows, ladder)


def convergence_movements(movements: DataFrame, archive: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Register movements of the checked kinds whose archive document is missing or not agreed.

    ``movements``: document_id, kind, deleted, posted, ... ``archive``:
    document_id, archive_document, archive_deleted, has_file, approval_own,
    approval_office, comment. All flags are texts.
    """
    rows = movements.where(F.col("kind").isin(*(kinds or fixed.CHECKED_MOVEMENTS))).join(archive, "document_id", "left")
    no, yes = fixed.NO, fixed.YES
    fine = (
        (F.col("posted") == yes) & (F.col("deleted") == no) & (F.col("has_file") == yes)
        & (F.col("archive_deleted") == no) & _agreed()
    )
    rows = rows.withColumn("has_error", yes_no(fine, no, yes))
    ladder = Ladder([
        Rule(F.col("archive_document").isNull(), "1", NO_ARCHIVE),
        Rule(F.col("archive_deleted") == yes, "2", ARCHIVE_DELETED),
        Rule(F.col("has_file") == no, "3", NO_SCAN),
        *_comment_rules(COMMENTS_MOVES),
    ], ("12", OTHER_ERRORS))
    return _errors(rows, ladder)
