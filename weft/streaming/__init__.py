"""Micro-batch forms of the batch operators."""
