"""Composed transforms and whole studies, each one lazy DataFrame graph."""
