"""Warehouse jobs: logs to detail tables, wide tables and reports.

Run one with ``python -m coursemill.plans JOB --root DIR [--ods DIR] [--dt DAY]``.
"""
