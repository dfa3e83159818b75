"""lodestream.plans"""
