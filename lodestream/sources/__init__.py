"""lodestream.sources"""
