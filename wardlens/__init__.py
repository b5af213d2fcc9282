"""Incident analytics and emergency-call monitoring as Spark DataFrame operators."""
