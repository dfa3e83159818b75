"""lodestream.functions"""
