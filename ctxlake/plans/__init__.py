"""Governed-metric evaluation over business tables."""
