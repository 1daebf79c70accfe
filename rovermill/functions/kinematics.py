"""Robot kinematics as column expressions. Constants follow the three converter generations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Robot:
    """Geometry and calibration. Fixed values."""

    track_m: float
    wheel_m: float
    linear_gain: float
    angular_gain: float
    angular_bias: float = 0.0
    control_offset_us: int = 0
    gps_offset_us: int = 0


FIRST = Robot(0.3, 0.05, 0.75, 0.75, 0.02, 0, -6_000_000)
GPS = Robot(0.206, 0.065, 0.75, 0.75, 0.02, 0, -6_000_000)
RPM = Robot(0.306, 0.065, 0.83, 0.9, 0.0, -500_000, 0)


def wheel_speed(rpm_1: Column, rpm_2: Column, rpm_3: Column, rpm_4: Column, robot: Robot) -> tuple[Column, Column]:
    """(v, omega) of a skid-steered robot from its four wheels (front left, front right, rear left, rear right)."""
    per_rpm = F.lit(math.pi * robot.wheel_m / 60.0)
    left, right = (rpm_1 + rpm_3) * per_rpm, (rpm_2 + rpm_4) * per_rpm
    return (right + left) / F.lit(2.0), (right - left) / F.lit(robot.track_m)


def command_speed(linear: Column, angular: Column, robot: Robot) -> tuple[Column, Column]:
    """(v, omega) that a command asks for."""
    return linear * F.lit(robot.linear_gain), (angular - F.lit(robot.angular_bias)) * F.lit(robot.angular_gain)


def compass_yaw(y: Column, z: Column) -> Column:
    """Heading of a magnetometer sample mounted upright."""
    return F.atan2(y, z) + F.lit(math.pi / 2)


def gauss(counts: Column) -> Column:
    return counts / F.lit(3000.0)


def crop_box(width: int, height: int, aspect: float = 4 / 3, scale: float = 0.5) -> tuple[int, int, int, int, int, int]:
    """left, top, right, bottom of the centred crop to an aspect ratio, and the size after scaling. Never leaves the image: what is too narrow loses height instead."""
    w, h = min(width, int(height * aspect)), height
    if w < int(height * aspect):
        h = min(height, int(width / aspect))
    left, top = (width - w) // 2, (height - h) // 2
    return left, top, left + w, top + h, max(1, int(w * scale)), max(1, int(h * scale))
