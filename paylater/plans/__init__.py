"""Composed plans: the warehouse build, the four gold marts and the KPI queries."""
