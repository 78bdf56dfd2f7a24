"""sluice.streaming"""
