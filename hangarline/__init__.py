"""Airline fleet operations warehouse and KPIs, expressed as Spark DataFrame plans."""
