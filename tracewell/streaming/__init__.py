"""Streams: near votes of trades that arrive one after another.

Detection is a batch job; this runs its join over micro-batches, for loads that trickle in.
"""
