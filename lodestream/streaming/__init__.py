"""lodestream.streaming"""
