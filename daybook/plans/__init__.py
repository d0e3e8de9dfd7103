"""Stages, analysis questions and registered queries."""
