"""caremarts.operators"""
