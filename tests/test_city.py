"""CityHash64 against the published values of the algorithm's own test."""

from plycask.functions.hashes import city64

# Fixed values of the published test: hashes of 0, 1, 2, ... bytes, i of them from place i * i on.
HASHES = """
    9ae16a3b2f90404f 541150e87f415e96 f3786a4b25827c1 ef923a7a1af78eab 11df592596f41d88 831f448bdc5600b3
    3eca803e70304894 1b5a063fb4c7f9f1 a0f10149a0e538d6 fb8d9c70660b910b 236827beae282a46 c385e435136ecf7c
    e3f6828b6017086d 851fff285561dca0 61152a63595a96d9 44473e03be306c88 3ead5f21d344056 6abbfde37ee03b5b
    943e7ed63b3c080 d72ce05171ef8a1a 4182832b52d63735 d6cdae892584a2cb 5c8e90bc267c5ee4 bbd7f30ac310a6f3
    36a097aa49519d97 dc78cb032c49217 441593e0da922dfe 2ba3883d71cc2133 f2b6d2adf8423600 38fffe7f3680d63c
    b7477bf0b9ce37c6 55bdb0e71e3edebd 782fa1b08b475e7 c5dc19b876d37a80 5e1141711d2d6706 782edf6da001234f
    d26285842ff04d44 c6ab830865a6bae6 44b3a1929232892 4b603d7932a8de4f 4ec0b54cf1566aff ed8b7a4b34954ff7
    5d28b43694176c26 6a1ef3639e1d202e 159f4d9e0307b111 cc0a840725a7e25b a2b27ee22f63c3f1 d8f2f234899bcab3
    584f28543864844f a94be46dd9aa41af 9a87bea227491d20 27688c24958d1a5c 5d1d37790a1873ad 1f03fd18b711eea9
    f0316f286cf527b6 297008bcb3e3401d 43c6252411ee3be ce38a9a54fad6599 270a9305fef70cf e71be7c28e84d119
    b5b58c24b53aaa19 44dd59bd301995cf b4d4789eb6f2630b 12807833c463737c e88419922b87176f 105191e0ec8f7f60
    a5b88bf7399a9f07 d08c3f5747d84f50 2f72d12a40044b4b aa1f61fdc5c2e11e 9489b36fe2246244 358d7c0476a044cd
    b0c48df14275265a
"""


def published_bytes(n):
    """The bytes that the published test hashes."""
    mask, k = 2**64 - 1, 0xC3A5C85C97CB3127
    a, b, out = 9, 777, bytearray(n)
    for i in range(n):
        a = (a + b) & mask
        b = (b + a) & mask
        a = (a ^ (a >> 41)) * k & mask
        b = ((b ^ (b >> 41)) * k + i) & mask
        out[i] = (b >> 37) & 255
    return bytes(out)


def test_every_length_of_a_position():
    data, hashes = published_bytes(6000), HASHES.split()
    assert len(hashes) > 72  # beyond 64 bytes the longest branch begins
    for n, wanted in enumerate(hashes):
        assert city64(data[n * n : n * n + n]) == int(wanted, 16), n
