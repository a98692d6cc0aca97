"""Reusable DataFrame operators; the plans combine them into named models."""
