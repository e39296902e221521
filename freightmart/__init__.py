"""Logistics and warehouse reporting mart expressed as Spark DataFrame jobs."""
