"""caremarts.streaming"""
