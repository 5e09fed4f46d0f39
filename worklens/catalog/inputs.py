"""Lazily built inputs and shared intermediate plans for one (session, data folder)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from worklens.catalog.run import FIXTURE
from worklens.context import RunContext
from worklens.plans import backlog, worklist
from worklens.session import forget_plans, plan_memo
from worklens.sources import fixtures


class Inputs:
    """Fixture views and the intermediate plans several queries start from.

    Nothing here runs a job (except the one-row dimension check); each
    property is a logical plan, so Catalyst still optimises every query as a
    whole.
    """

    def __new__(cls, spark: SparkSession, sf_dir: str, ctx: RunContext = FIXTURE):
        # One instance (hence one set of logical plans) per session, folder and
        # run context: repeated queries skip rebuilding identical plans.  No
        # data is cached; every action re-reads its inputs.
        memo = plan_memo(spark, "inputs")
        key = (sf_dir.rstrip("/"), ctx)
        if key not in memo:
            inst = super().__new__(cls)
            inst.spark, inst.sf_dir, inst.ctx = spark, sf_dir, ctx
            memo[key] = inst
        return memo[key]

    @classmethod
    def forget(cls, spark: SparkSession) -> None:
        """Drop the memoised plans (e.g. after the input files changed)."""
        forget_plans(spark)

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @cached_property
    def buyers(self) -> DataFrame:
        return fixtures.buyers_cat(self.spark, self.sf_dir)

    @cached_property
    def backlog_raw(self) -> DataFrame:
        return fixtures.backlog_raw(self.spark, self.sf_dir)

    @cached_property
    def approver_raw(self) -> DataFrame:
        return fixtures.approver_raw(self.spark, self.sf_dir)

    @cached_property
    def po_data(self) -> DataFrame:
        return fixtures.po_data(self.spark, self.sf_dir)

    @cached_property
    def po_docs(self) -> DataFrame:
        return fixtures.po_docs(self.spark, self.sf_dir)

    @cached_property
    def req_docs(self) -> DataFrame:
        return fixtures.req_docs(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return backlog.clean_backlog(self.backlog_raw, self.buyers, self.ctx)

    @cached_property
    def split(self) -> DataFrame:
        return backlog.status_split(self.clean)

    @cached_property
    def prepared(self) -> DataFrame:
        return worklist.prepared_worklist(self.approver_raw, self.ctx)

    # With every column of the extracts, for the archive.
    @cached_property
    def whole_split(self) -> DataFrame:
        rows = fixtures.backlog_raw(self.spark, self.sf_dir, whole=True)
        return backlog.status_split(backlog.clean_backlog(rows, self.buyers, self.ctx))

    @cached_property
    def whole_prepared(self) -> DataFrame:
        return worklist.prepared_worklist(
            fixtures.approver_raw(self.spark, self.sf_dir, whole=True), self.ctx)

    @cached_property
    def amounts(self) -> DataFrame:
        """The worklist's amounts and ages, from the whole extract's few columns they need."""
        return worklist.worklist_amounts(
            fixtures.approver_raw(self.spark, self.sf_dir, whole=True), self.ctx)

    @cached_property
    def po_documents(self) -> DataFrame:
        return fixtures.po_documents(self.spark, self.sf_dir)

    @cached_property
    def req_documents(self) -> DataFrame:
        return fixtures.req_documents(self.spark, self.sf_dir)
