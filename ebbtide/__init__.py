"""Ebbtide: subscription-churn analytics as Spark table-to-table operators."""
