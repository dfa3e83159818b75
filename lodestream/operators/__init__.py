"""lodestream.operators"""
